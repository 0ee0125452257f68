import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stackroom.functions import ids, paths, runs
from stackroom.functions.abstracts import abstract_from_json, abstract_from_map, parse_inverted_index
from stackroom.functions.citations import author_display_name, citation

ABSTRACTS = [
    ('{"world":[1],"Hello":[0]}', "Hello world"),
    ('{"the":[0,2],"big":[1],"dog":[3]}', "the big the dog"),
    ("{}", ""),
    ('{"a\\"b":[0]}', 'a"b'),
    ("not json", None),
    ("", None),
    (None, None),
    ('{"a":[0],"a":[5]}', "a a"),
    ('{"b":[0],"a":[5],"b":[7]}', "b a b"),
    ('{"a":[]}', ""),
    ('{"b":[0],"a":[0]}', "a b"),
    ('{"z":[0],"Z":[0],"é":[0]}', "Z z é"),
    ('{"a":[-1],"b":[0]}', "a b"),
    ('{"":[0],"x":[1]}', " x"),
    ('  {"a":[0]}', "a"),
    ('{"a":[0]} trailing', "a"),
    ('{"a":[0]}{"b":[1]}', "a"),
    ('{"a":[null]}', None),
    ('{"b":[0],"a":[null]}', None),
    ('{"a":null}', None),
    ('{"a":[0],"b":null}', None),
    ('{"a":[0],"b":["x"]}', None),
    ('{"a":["1"]}', None),
    ('{"a":[1.5]}', None),
    ('{"a":[1e2]}', None),
    ('{"a":[true]}', None),
    ('{"a":[[0]]}', None),
    ('{"a":[0],"b":{"c":1}}', None),
    ('{"a":[99999999999999999999]}', None),
    ('{"a":[NaN]}', None),
    ('{"a":[01]}', None),
    ('{"a":[0],}', None),
    ('{"a":[0]', None),
    ('{"a":[0]]', None),
    ("{'a':[0]}", None),
    ("{a:[0]}", None),
    ('/*c*/{"a":[0]}', None),
    ('{"x\ny":[0]}', None),
    ("[]", None),
    ("null", None),
]


def column(spark, values, kind, expression):
    """Apply an expression to a column ``x`` of the values, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    got = rows.select("i", expression(F.col("x")).alias("y")).collect()
    return [row["y"] for row in sorted(got, key=lambda r: r["i"])]


def test_abstract_from_json(spark):
    got = column(spark, [text for text, _ in ABSTRACTS], "string", abstract_from_json)
    assert list(zip([t for t, _ in ABSTRACTS], got)) == ABSTRACTS


def test_repeated_keys_stay_two_entries(spark):
    got = column(spark, ['{"a":[0],"a":[5]}'], "string", lambda c: F.size(parse_inverted_index(c)))
    assert got == [2]


def test_abstract_from_map_like_the_sql_expression(spark):
    maps = [
        {"world": [1], "Hello": [0]},
        {"the": [0, 2], "big": [1]},
        {},
        None,
        {"a": [], "b": [3]},
        {"late": [None], "first": [0]},
        {"gone": None, "here": [1]},
    ]
    got = column(spark, maps, "map<string,array<bigint>>", abstract_from_map)
    sql = """
        SELECT CASE WHEN m IS NULL THEN NULL ELSE array_to_string(list_transform(list_sort(flatten(
            list_transform(map_entries(m), lambda x: list_transform(x.value, lambda p: {pos: p, word: x.key})))),
            lambda e: e.word), ' ') END
        FROM (SELECT CAST(? AS MAP(VARCHAR, BIGINT[])) AS m)"""
    con = duckdb.connect()

    def literal(m):
        if m is None:
            return None
        items = ", ".join(f"'{k}': {'NULL' if v is None else str(v).replace('None', 'NULL')}" for k, v in m.items())
        return f"MAP {{{items}}}"

    for m, ours in zip(maps, got):
        text = literal(m)
        query = sql.replace("?", "NULL" if text is None else text)
        theirs = con.execute(query).fetchone()[0]
        assert ours == (theirs if theirs is not None or m is None else ""), m


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), min_size=1).filter(lambda w: " " not in w), max_size=30))
def test_round_trip_of_any_words(spark, words):
    text = " ".join(words)
    entries = F.transform(
        F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>"),
        lambda w, i: F.to_json(F.create_map(w, F.array(i.cast("bigint")))),
    )
    bare = F.transform(entries, lambda e: F.substring(e, F.lit(2), F.length(e) - 2))
    json = F.concat(F.lit("{"), F.array_join(bare, ","), F.lit("}"))
    assert spark.range(1).select(abstract_from_json(json).alias("a")).first()["a"] == text


AUTHORS = "array<struct<author:struct<display_name:string>>>"


def people(*names):
    return [((name,),) for name in names]


@pytest.mark.parametrize("year_type", ["int", "bigint"])
def test_citation(spark, year_type):
    cases = [
        (None, 2020, None),
        ([], 2020, None),
        (people("A"), 2020, "A (2020)"),
        (people("A"), None, "A (n.d.)"),
        (people("A", "B"), 2020, "A & B (2020)"),
        (people("A", "B", "C"), 2020, "A et al. (2020)"),
        (people(None), 2020, None),
        (people(None, "B"), 2020, None),
        (people("A", None), 2020, None),
        (people("A", None, "C"), 2020, "A et al. (2020)"),
        (people(None, "B", "C"), 2020, None),
        ([(None,), (("B",),)], 2020, None),
        (people(""), 2020, " (2020)"),
    ]
    rows = spark.createDataFrame(
        [(i, a, y) for i, (a, y, _) in enumerate(cases)], f"i int, a {AUTHORS}, y {year_type}"
    )
    got = rows.orderBy("i").select(citation(F.col("a"), F.col("y")).alias("c")).collect()
    assert [r["c"] for r in got] == [c for _, _, c in cases]


def test_citation_reads_only_the_names(spark, tmp_path):
    schema = "authorships array<struct<author:struct<display_name:string,orcid:string>,position:string>>, publication_year int, title string"
    spark.createDataFrame([([(("A", "o"), "first")], 2020, "t")], schema).write.parquet(f"{tmp_path}/w")
    plan = spark.read.parquet(f"{tmp_path}/w").select(citation(F.col("authorships"), F.col("publication_year")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    read = text[text.index("ReadSchema") :]
    assert "display_name" in read and "orcid" not in read and "position" not in read


def test_author_display_name_beyond_the_end(spark):
    got = column(spark, [people("A"), [], None], AUTHORS, lambda c: author_display_name(c, 1))
    assert got == [None, None, None]


def test_id_block(spark):
    cases = {
        "https://example.org/W123": 0,
        "W20001": 2,
        "W": None,
        "": None,
        None: None,
        "W000": 0,
        "W0000000000000000000000000020001": 2,
        "W9223372036854775807": (922337203685477 + 2**31) % 2**32 - 2**31,
        "W9223372036854775808": None,
        "W99999999999999999999": None,
        "W21474836480000": -(2**31),
        "W1/": None,
        "W1\n": None,
        "W٣": None,
        "languages/en": None,
    }
    assert column(spark, list(cases), "string", ids.id_block) == list(cases.values())


def test_normalize_canonical_and_dataset(spark, scheme):
    url = "https://example.org/"
    cases = [
        ("W123", "W123", url + "W123", "works"),
        (' "W1" ', "W1", url + "W1", "works"),
        ("\"'W1'\"", "W1", url + "W1", "works"),
        ("'\"W1\"'", '"W1"', url + '"W1"', None),
        (url + "A5073096074", "A5073096074", url + "A5073096074", "authors"),
        (url + "W1/", "W1", url + "W1/", "works"),
        ("http://example.org/countries/us", "countries/us", "http://example.org/countries/us", "countries"),
        ("https://exampleXorg/W1", "https://exampleXorg/W1", url + "https://exampleXorg/W1", None),
        ("w1", "w1", url + "w1", "works"),
        (" A1\t", "A1", url + "A1", "authors"),
        ('" W1 "', " W1 ", url + " W1 ", "works"),
        ("/W1/", "W1", url + "W1", "works"),
        ("Countries/US", "Countries/US", url + "Countries/US", "countries"),
        ("institution-types/other", "institution-types/other", url + "institution-types/other", "institution-types"),
        ("continents/europe", "continents/europe", url + "continents/europe", "continents"),
        ("foo/x", "foo/x", url + "foo/x", None),
        ("X999", "X999", url + "X999", None),
        ("ıx", "ıx", url + "ıx", None),
        ('""', "", url, None),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string")
    normalized = ids.normalize_id(F.col("raw"), scheme)
    got = rows.orderBy("i").select(
        "raw", normalized, ids.canonical_id(F.col("raw"), scheme), ids.dataset_of(normalized)
    )
    assert [tuple(r) for r in got.collect()] == cases


def test_every_letter_and_namespace_has_its_dataset(spark):
    names = {f"{letter}1": name for letter, name in ids.LETTERS.items()}
    names |= {f"{name}/x": name for name in ids.NAMESPACES}
    assert len(names) == 21
    assert column(spark, list(names), "string", ids.dataset_of) == list(names.values())


def test_manifest_url_to_local(spark):
    cases = {
        "s3://b/data/parquet/works/updated_date=1/p.parquet": "works_aws/updated_date=1/p.parquet",
        "s3://b/data/parquet/authors/p.parquet": "authors/p.parquet",
        "s3://b/data/parquet/works": "works_aws",
        "s3://b/data/parquet/a/data/parquet/b": "a/data/parquet/b",
        "s3://b/other/p.parquet": None,
    }
    assert column(spark, list(cases), "string", paths.manifest_url_to_local) == list(cases.values())


def test_relative_path(spark):
    given_paths = ["file:///c/parquet/works/a b.parquet", "file:/c/parquet/x.parquet", "/c/parquet//y", "/d/z"]
    got = column(spark, given_paths, "string", lambda c: paths.relative_path(c, "file:///c/parquet/"))
    assert got == ["works/a b.parquet", "x.parquet", "/y", "/d/z"]
    with pytest.raises(ValueError):
        paths.relative_path(F.col("x"), "c/parquet")


def test_parse_counter(spark):
    cases = {
        "1 [x] ok=12 failed=3": 12,
        "ok=+5": 5,
        "book= 7 ok=9": 7,
        "ok=a1 ok=2": None,
        "ok=-1": None,
        "ok=1.5": None,
        "ok=": None,
        "none": None,
    }
    assert column(spark, list(cases), "string", lambda c: runs.parse_counter(c, "ok")) == list(cases.values())


def test_format_duration(spark):
    cases = {0.4: "0s", 2.5: "3s", 59.5: "1m00s", 123.0: "2m03s", 3723.0: "1h02m03s", -4.0: "0s", 360000.0: "100h00m00s"}
    assert column(spark, list(cases), "double", runs.format_duration) == list(cases.values())
    assert column(spark, [None], "double", runs.format_duration) == [None]


def test_commands(spark):
    cases = {
        "verify-convert": ("verify", 5),
        "validate-download": ("verify_download", 2),
        "verify_index": ("verify-index", 9),
        "verify-schema": ("verify_schema", 6),
        "extract": ("extract", 8),
        "all": ("all", 0),
        "other": ("other", 100),
    }
    names = list(cases)
    folded = column(spark, names, "string", runs.canonical_command)
    ranks = column(spark, names, "string", runs.command_flow_rank)
    assert list(zip(folded, ranks)) == list(cases.values())


def test_headroom_holds_at_the_largest_number(spark):
    got = column(spark, [100, 9, 2**62, None], "bigint", lambda c: runs.with_headroom(c, 11))
    assert got == [110, 9, (2**63 - 1) // 10, None]
    assert column(spark, [5 * 2**30 + 1], "bigint", runs.whole_gib) == [5]
