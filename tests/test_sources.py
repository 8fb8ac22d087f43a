import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cdmloom.functions import values
from cdmloom.functions.keys import hash_key, key_collisions, md5_key, natural_key, row_number_key, wide_key
from cdmloom.model.spec import BY_RELATIONSHIP, Lookup, Rule, Rules, Source
from cdmloom.model.vocabulary import VOCABULARY_TABLES
from cdmloom.operators import profiling
from cdmloom.operators.expectations import expectation_metrics
from cdmloom.operators.lookups import apply_lookups
from cdmloom.plans.build import store_with_metrics
from cdmloom.sources import concept_map, vocabulary_files
from cdmloom.sources.tables import StaleVersion, commits, held, read_sources, read_target, remove_versions, write_target
from tests.conftest import rows

HEADER = "\t".join(VOCABULARY_TABLES["concept"].names)


def test_vocabulary_files(spark, tmp_path):
    lines = [
        HEADER,
        '1\t5" needle\tDevice\tV\tK\tS\tA\t19700101\t20991231\t',
        "2\tplain\tDevice\tV\tK\t\tB\t19700101\t20991231\tD",
        "x\tbad id\tDevice\tV\tK\t\tC\t19700101\t20991231\t",
    ]
    (tmp_path / "CONCEPT.csv").write_text("\n".join(lines) + "\n")
    tables = vocabulary_files.load_vocabulary(spark, str(tmp_path))
    assert set(tables) == set(VOCABULARY_TABLES)
    got = tables["concept"].select("concept_id", "concept_name", "standard_concept", "invalid_reason")
    assert rows(got) == [
        (None, "bad id", None, None), (1, '5" needle', "S", None), (2, "plain", None, "D"),
    ]
    assert tables["domain"].count() == 0  # its file is missing
    assert tables["vocabulary"].schema == VOCABULARY_TABLES["vocabulary"]
    report = {r["table_name"]: tuple(r)[1:] for r in vocabulary_files.load_report(spark, str(tmp_path)).collect()}
    assert report.pop("concept") == ("OK", 3, 1, 0, 0)
    assert len(report) == len(VOCABULARY_TABLES) - 1 and set(report.values()) == {("SKIP", 0, 0, 0, 0)}
    with pytest.raises(RuntimeError, match="concept_relationship"):
        vocabulary_files.require_non_empty(tables)
    assert rows(vocabulary_files.require_non_empty(tables, ["concept"])) == [("concept", 3)]


def test_stored_vocabulary_round_trip(spark, vocab, tmp_path):
    back = vocabulary_files.store_vocabulary({"concept": vocab.concept}, str(tmp_path))
    assert rows(back["concept"]) == rows(vocab.concept)


def test_gated_concepts_come_second(spark):
    shape = "concept_id INT, concept_name STRING"
    own = spark.createDataFrame([(1, "own"), (2, "own")], shape)
    gated = spark.createDataFrame([(2, "gated"), (3, "gated"), (3, "gated")], shape)
    got = vocabulary_files.union_license_gated(own, gated)
    assert rows(got) == [(1, "own"), (2, "own"), (3, "gated")]


@pytest.fixture(scope="module")
def seed(spark):
    data = [
        ("a", "0", "Race", "A", "7", "STD", "19700101", "20991231", ""),
        ("b", "0", "Race", "B", "?", "STD", "1970-01-01", "20991231", " "),
    ]
    return spark.createDataFrame(data, ", ".join(f"{c} STRING" for c in concept_map.MAP_COLUMNS))


def test_seed_rows(seed):
    got = rows(concept_map.normalize_seed_map(seed).drop("source_code_description"))
    end = dt.date(2099, 12, 31)
    assert got == [
        ("a", 0, "Race", 7, "STD", dt.date(1970, 1, 1), end, None),
        ("b", 0, "Race", None, "STD", None, end, None),
    ]


def test_upsert_is_idempotent_and_updates(seed):
    new = concept_map.normalize_seed_map(seed)
    old = new.withColumn("target_concept_id", F.lit(1)).withColumn(
        "source_vocabulary_id", F.when(F.col("source_code") == "b", "Other").otherwise("Race")
    )
    once = concept_map.upsert_concept_map(old, new)
    keys = once.select("source_code", "source_vocabulary_id", "target_concept_id")
    assert rows(keys) == [("a", "Race", 7), ("b", "Other", 1), ("b", "Race", None)]
    assert rows(concept_map.upsert_concept_map(once, new)) == rows(once)


def test_upsert_refuses_repeated_keys(seed):
    new = concept_map.normalize_seed_map(seed)
    with pytest.raises(ValueError, match="seed repeats keys"):
        concept_map.upsert_concept_map(new, new.unionByName(new))


def test_draft_file(spark, seed, tmp_path):
    concept_map.write_draft_map(seed.select(*reversed(seed.columns)), str(tmp_path / "d"))
    back = spark.read.option("header", True).csv(str(tmp_path / "d"))
    assert tuple(back.columns) == concept_map.MAP_COLUMNS


def test_sources_and_targets(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_target(spark.range(3), path)
    assert write_target(spark.range(5), path).count() == 5
    frames = read_sources(spark, [Source("a", "{root}/t")], {"root": str(tmp_path)})
    assert frames["a"].select("a.id").count() == 5


def test_an_aborted_build_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_target(spark.range(5), path)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("rule"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="rule"):
        write_target(broken, path)
    assert read_target(spark, path).count() == 5
    write_target(read_target(spark, path).limit(2), path)
    assert read_target(spark, path).count() == 2
    assert read_target(spark, path, back=1).count() == 5


def test_seed_is_stored_and_storing_it_twice_changes_nothing(spark, seed, tmp_path):
    path = f"{tmp_path}/map"
    write_target(seed.limit(1), path)
    once = rows(concept_map.store_upsert(spark, seed, path))
    assert rows(concept_map.store_upsert(spark, seed, path)) == once
    assert len(once) == seed.count()


def test_a_vocabulary_file_that_does_not_fit_is_an_error(spark, tmp_path):
    (tmp_path / "CONCEPT_SYNONYM.csv").write_text("concept_id\tconcept_synonym_name\n1\tx\n2\ty\n")
    with pytest.raises(ValueError, match="language_concept_id"):
        vocabulary_files.load_vocabulary(spark, str(tmp_path))


def test_rules_are_counted_while_a_table_is_stored(spark, tmp_path):
    rules = Rules(drop=(Rule("small", "id < 8"),), warn=(Rule("even", "id % 2 = 0"),))
    table, metrics = store_with_metrics(spark.range(10), rules, f"{tmp_path}/t")
    assert table.count() == 8
    assert rows(metrics) == rows(expectation_metrics(spark.range(10), rules))


# Expressions


def test_keys_keep_null_slots(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x STRING, y STRING, z STRING")
    for key in (hash_key, md5_key):
        assert df.select(F.expr(key("x", "y", "z"))).distinct().count() == 2
        assert df.select(F.expr(key("x"))).distinct().count() == 1


def test_row_numbers_follow_the_order(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as n").repartition(7)
    got = row_number_key(df, ["n"], "i").collect()
    assert sorted((r["n"], r["i"]) for r in got) == [(n, n + 1) for n in range(1000)]


def test_values(spark):
    df = spark.createDataFrame([("12.5", " ", "20200230")], "a STRING, b STRING, c STRING")
    df = df.unionByName(spark.createDataFrame([("n/a", "x", "20200229")], df.schema))
    got = df.select(
        values.safe_number(F.col("a")),
        values.blank_to_null(F.col("b")),
        values.compact_date(F.col("c")),
        values.source_value(F.repeat("a", 40)),
        values.case_map(F.col("b"), {"x": 5}),
        values.case_map(F.col("b"), {}),
    ).collect()
    assert tuple(got[0])[:3] == (12.5, None, None)
    assert tuple(got[1])[:3] == (None, "x", dt.date(2020, 2, 29))
    assert [len(r[3]) for r in got] == [160, 120]
    assert [r[4:] for r in map(tuple, got)] == [(0, 0), (5, 0)]


# Profiles


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b")], "k INT, v STRING")
    assert rows(profiling.column_profile(df)) == [("k", 4, 1, 2), ("v", 4, 1, 2)]
    assert rows(profiling.column_profile(df, profiling.dense_columns(df))) == [("k", 4, 1, 2), ("v", 4, 1, 2)]
    assert rows(profiling.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(profiling.null_rates(df, ["k", "v"])) == [("k", 1, 4, 0.25), ("v", 1, 4, 0.25)]
    assert rows(profiling.code_frequency(df, "v")) == [(None, 1), ("a", 2), ("b", 1)]
    assert [tuple(r) for r in profiling.top_codes(df, "v", 1).collect()] == [("a", 2)]
    other = spark.createDataFrame([(1,), (1,), (2,)], "j INT")
    assert rows(profiling.join_fanout_check(df, ["k"], other, ["j"])) == [
        ("many", 1, 2, 4), ("none", 1, 1, 1), ("one", 1, 1, 1),
    ]


# Versions


def test_two_writers_both_stay_in_order(spark, tmp_path):
    path = f"{tmp_path}/t"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: write_target(spark.range(n), path), range(1, 9)))
    assert commits(spark, path) == list(range(8))
    assert sorted(read_target(spark, path, number=n).count() for n in range(8)) == list(range(1, 9))


def test_upserts_at_one_time_are_both_kept(spark, seed, tmp_path):
    path = f"{tmp_path}/map"
    write_target(seed.limit(0), path)
    parts = [seed.where(F.col("source_code") == r[0]) for r in seed.select("source_code").distinct().collect()][:3]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda part: concept_map.store_upsert(spark, part, path), parts))
    assert read_target(spark, path).count() == sum(p.count() for p in parts)


def test_a_writer_that_read_an_old_version_is_told(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_target(spark.range(1), path)
    write_target(spark.range(2), path, base=0)
    with pytest.raises(StaleVersion):
        write_target(spark.range(3), path, base=0)
    assert read_target(spark, path).count() == 2


def test_old_versions_go_unless_they_are_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(1, 6):
        write_target(spark.range(n), path)
    assert remove_versions(spark, path) == []  # none is old enough
    with held(spark, path) as df:
        write_target(spark.range(9), path)
        assert remove_versions(spark, path, keep=1, older_than=0) == [0, 1, 2, 3]
        assert df.count() == 5
    assert remove_versions(spark, path, keep=1, older_than=0) == [4]
    assert commits(spark, path) == [5] and read_target(spark, path).count() == 9
    assert write_target(spark.range(4), path).count() == 4 and commits(spark, path) == [5, 6]
    with pytest.raises(ValueError):
        remove_versions(spark, path, keep=0)


def test_lines_that_do_not_fit_go_to_quarantine(spark, tmp_path):
    header = "concept_id\tconcept_synonym_name\tlanguage_concept_id\n"
    (tmp_path / "CONCEPT_SYNONYM.csv").write_text(header + '1\tfine "\t5\n2\tcut\n3\ttoo\t5\tmuch\n\n4\t\t5\n')
    table = vocabulary_files.load_vocabulary(spark, str(tmp_path))["concept_synonym"]
    assert [r["concept_id"] for r in table.orderBy("concept_id").collect()] == [1, 4]
    assert table.select("concept_id").count() == table.count() == 2
    assert rows(vocabulary_files.quarantined_lines(spark, str(tmp_path))) == [
        ("concept_synonym", "long", "3\ttoo\t5\tmuch"), ("concept_synonym", "short", "2\tcut"),
    ]
    report = {r["table_name"]: tuple(r)[1:] for r in vocabulary_files.load_report(spark, str(tmp_path)).collect()}
    assert report["concept_synonym"] == ("OK", 2, 0, 1, 1)
    assert report["domain"] == ("SKIP", 0, 0, 0, 0)


# Keys


def test_keys_tell_all_lists_of_parts_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("", None), (None, ""), ("1:a", "b"), ("a", "1:b"), ("~", None)], "x STRING, y STRING")
    for key in (hash_key, md5_key, wide_key):
        assert df.select(F.expr(key("x", "y"))).distinct().count() == 7


def test_a_key_is_null_where_a_part_that_names_the_row_is(spark):
    df = spark.createDataFrame([(1, 2, None), (1, None, "a")], "x INT, y INT, z STRING")
    got = df.select("y", F.expr(natural_key(hash_key, ("x", "y"), "z")).alias("k")).collect()
    assert [(r["y"] is None, r["k"] is None) for r in got] == [(False, False), (True, True)]


def test_colliding_keys_are_found(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "d")], "k INT, p STRING")
    assert rows(key_collisions(df, "k", "p")) == [(1, 2, 2)]


def test_profile_counts_numbers_as_numbers(spark):
    df = spark.sql(
        "select id * 3 - 50000 as `a.b`, if(id % 7 = 0, null, id % 1000) as few, id * 1000000007 as far, cast(id % 9 as string) as text, "
        "date_add(date '2020-01-01', cast(id % 400 as int)) as day, cast(id % 11 as double) as d, cast(null as int) as none, id % 2 = 0 as flag from range(40000)"
    )
    want = [
        ("a.b", 40000, 0, 40000), ("d", 40000, 0, 11), ("day", 40000, 0, 400), ("far", 40000, 0, 40000),
        ("few", 40000, 5715, 1000), ("flag", 40000, 0, 2), ("none", 40000, 40000, 0), ("text", 40000, 0, 9),
    ]
    dense = profiling.dense_columns(df)
    assert dense == ["a.b", "few", "day", "flag"]
    assert rows(profiling.column_profile(df, dense)) == rows(profiling.column_profile(df)) == want
    assert profiling.dense_columns(df.limit(0)) == [] and profiling.column_profile(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="text"):
        profiling.column_profile(df, ["text"])


def test_distribution_from_codes_reads_facts_once(spark, vocab):
    facts = spark.createDataFrame([("A",)] * 3 + [("B",)] * 2 + [("C",), (None,), ("A",)], "code STRING")
    after = replace(vocab, concept_relationship=vocab.concept_relationship.filter("concept_id_2 <> 102"))
    lookup = Lookup("f", "code", "concept_id", BY_RELATIONSHIP, vocabulary_id="LOC", domain_id="Condition")
    one = profiling.code_distribution_diff(facts, lookup, vocab, after)
    both = [apply_lookups(facts.alias("f"), [lookup], v) for v in (vocab, after)]
    assert rows(one) == rows(profiling.concept_distribution_diff(*both, "concept_id"))
    assert sum(r["rows_before"] for r in one.collect()) >= 8
