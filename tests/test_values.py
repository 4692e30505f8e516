from datetime import date

from pyspark.sql import functions as F

from geosync.functions import dates, jsonx, text
from geosync.operators import purge, schema


def run(spark, values, *exprs, kind="string"):
    """Rows of the expressions over one column ``v``."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", *[e.alias(f"x{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()
    return [tuple(r)[1] if len(exprs) == 1 else tuple(r)[1:] for r in rows]


def test_column_names(spark):
    given = {
        "OrderNumber": "order_number", "CustomerConstructionINN": "customer_construction_inn", " x ": "x",
        "Дата": None, "id": None, "geom": None, "2ndFloor": "field_2nd_floor", "a--b__c": "a_b_c", "": None,
        "global_id": "global_id", "HTTPServer": "http_server", "a" * 80: "a" * 63,
    }
    assert run(spark, list(given), text.to_column_name(F.col("v"))) == list(given.values())


def test_text_dates(spark):
    given = {
        "2024-02-01": date(2024, 2, 1), "2024-02-01T10:00:00": date(2024, 2, 1), "2024-02-01 abc": None,
        "01.02.2024": date(2024, 2, 1), "01.02.24": date(2024, 2, 1), "01.02.70": date(1970, 2, 1),
        "01.02.69": date(2069, 2, 1), "31.02.2024": None, " 01.02.2024 ": date(2024, 2, 1), "": None, "soon": None,
    }
    assert run(spark, list(given), dates.parse_text_date(F.col("v"))) == list(given.values())


def test_sheet_dates(spark):
    given = {
        "2026-08-12": date(2026, 8, 12), "12.8.2026": date(2026, 8, 12), "12/08/2026": date(2026, 8, 12),
        "45292": date(2024, 1, 1), "59": date(1900, 2, 28), "61": date(1900, 3, 1), "0.5": None, "x": None, None: None,
    }
    assert run(spark, list(given), dates.multi_format_date(F.col("v"))) == list(given.values())


def test_paths(spark):
    given = {
        "dir\\a.jpg": ("dir/a.jpg", None), "/abs": (None, "absolute path"), "C:\\x": (None, "absolute path"),
        "\\\\share\\x": (None, "absolute path"), "a/../b": (None, "path traversal"), "  ": (None, "empty path"),
        None: (None, "empty path"), "a//b/": ("a/b", None),
    }
    found = run(spark, list(given), text.normalize_path(F.col("v")))
    assert [tuple(r) for r in found] == list(given.values())
    marked = {
        "Z:\\Заказы\\12\\34": ("12/34", None), "//host/ЗАКАЗЫ/x": ("x", None), "a/b": (None, "no marker"),
        "a/заказы/": (None, "ends at marker"), "заказы/../x": (None, "path traversal"), "": (None, "empty path"),
    }
    found = run(spark, list(marked), text.path_after_marker(F.col("v"), "Заказы"))
    assert [tuple(r) for r in found] == list(marked.values())


def test_file_names(spark):
    given = {
        "a b.JPG": ("a_b.JPG", None), "../x/p.png": ("p.png", None), "": (None, "filename is required"),
        "..": (None, "filename is required"), "***": (None, "invalid filename"),
        "x.gif": (None, "allowed extensions: .jpg, .jpeg, .png"), "x" * 300 + ".jpeg": ("x" * 195 + ".jpeg", None),
    }
    found = run(spark, list(given), text.sanitize_file_name(F.col("v")))
    assert [tuple(r) for r in found] == list(given.values())


def test_labels(spark):
    given = ["Восточное\r\n  Измайлово", " Ново - Переделкино ", "  ", None, "-"]
    assert run(spark, given, text.normalize_label(F.col("v"))) == [
        "Восточное_Измайлово", "Ново_Переделкино", None, None, "",
    ]


def test_keys_are_stable_and_distinct(spark):
    a, b, again = run(spark, ["point:1", "point:2", "point:1"], text.item_key(F.col("v")))
    assert a == again != b and len(a) == 36


def test_maybe_dict(spark):
    given = ['{"a": 1}', "{'a': 'it\\'s', 'b': None, 'c': (1, True)}", "[1]", "junk", None, '"x"']
    found = run(spark, given, jsonx.maybe_dict(F.col("v")))
    assert [f is not None for f in found] == [True, True, False, False, False, False]
    assert found[1] == """{"a": "it's", "b": null, "c": [1, true]}"""


def test_documents(spark):
    given = {
        '{"wkt": "POINT (1 2)", "uuids": []}': "order", '{"uuids": []}': "uuid_area", '{"wkt": " "}': None,
        '{"uuid": "a", "upload_at": "x", "azimuth_deg": 1}': "uploaded_photo", '{"uuid": "", "upload_at": "x", "date": 1}': "upload",
        '{"lat": null, "lng": null}': "photo_meta", '{"lat": 1}': None, "{}": "upload", "[]": None, "5": None,
    }
    assert run(spark, list(given), jsonx.classify_document(F.col("v"))) == list(given.values())


def test_coordinates(spark):
    given = {
        '{"lat": 55.7, "lng": 37.6}': (55.7, 37.6), '{"latitude": "55.7", "longitude": "37.6"}': (55.7, 37.6),
        '{"lat": null, "lng": 1, "latitude": 1, "longitude": 1}': None, '{"lat": 1}': None, '{"lat": "", "lng": 1}': None,
        '{"lat": 91, "lng": 1}': None, '{"lat": "NaN", "lng": 1}': None,
    }
    found = run(spark, list(given), jsonx.parse_coords(F.col("v")))
    assert [tuple(r) if r else None for r in found] == list(given.values())


def test_envelopes(spark):
    given = ['{"features": [{"a": 1.0}]}', '{"data": [1, 2]}', '{"Items": []}', "[3]", '{"features": 5}', "x"]
    assert run(spark, given, jsonx.unwrap_envelope(F.col("v"))) == [['{"a":1.0}'], ["1", "2"], [], ["3"], None, None]


def types_of(spark, docs):
    df = spark.createDataFrame([(d,) for d in docs], "d string").withColumn("members", jsonx.flatten_properties(F.col("d")))
    return dict(schema.type_list(schema.infer_types(df)))


def test_type_rules(spark):
    docs = [
        '{"i": 1, "f": 1, "bf": true, "bi": true, "s": 1, "j": "x", "n": null, "b": true}',
        '{"i": 2, "f": 1.5, "bf": 1.5, "bi": 1, "s": "x", "j": [1], "n": null, "b": false}',
    ]
    assert types_of(spark, docs) == {
        "i": "bigint", "f": "double", "bf": "double", "bi": "string", "s": "string", "j": "json", "n": "string", "b": "boolean",
    }


def test_nested_attributes_win(spark):
    doc = '{"OrderNumber": "flat", "geometry": 1, "Wkt": "x", "attributes": "{\'OrderNumber\': \'deep\', \'order_number\': \'last\'}"}'
    found = run(spark, [doc], jsonx.flatten_properties(F.col("v")))[0]
    assert [(m["name"], m["raw"]) for m in found] == [("order_number", "last")]


def test_purge_keeps_unreadable_and_linked(spark):
    rows = [(1, "01.01.2020", None, False), (2, "junk", None, False), (3, "01.01.2020", "k", False), (4, "01.01.2020", None, True),
            (5, "2024-05-15", None, False), (6, "2024-05-16", None, False), (7, None, None, None)]
    df = spark.createDataFrame(rows, "id int, d string, task_key string, tasked boolean")
    tagged = purge.purge_date(df, "d", F.lit(date(2024, 6, 15)))
    assert {r["id"] for r in tagged.filter("action = 'delete'").collect()} == {1, 5}
    assert purge.purge_date(df, "absent", F.lit(date(2024, 6, 15))).filter("action = 'delete'").count() == 0


def test_sql_names_agree(spark):
    from geosync.functions import sqlnames

    sqlnames.register(spark)
    values = ["2024-02-01", "01.02.99", "01.02.24", "2024-02-01 x", "Ново - Пере\r\nделкино", " a  b ", None, "", "-", "in 2019 or so"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    pairs = {
        "parse_text_date": dates.parse_text_date, "extract_year": dates.extract_year, "normalize_attr": text.normalize_attr,
        "normalize_label": text.normalize_label,
    }
    for name, function in pairs.items():
        rows = df.select(F.expr(f"{name}(v)").alias("a"), function(F.col("v")).alias("b")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows], name
