import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from tidegate.plans import ordering, patterns
from tidegate.plans.keys import beside, matching
from tidegate.plans import sieve
from tidegate.plans.sieve import likely
from tidegate.plans.skew import measured_join, salted_join, thinned
from tidegate.session import path_exists, scratch_path, shared_root, written


def like_regex(pattern):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.compile(out, re.S)


def words(rng, alphabet, count, longest):
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(count)})


@pytest.mark.parametrize("shapes", [64, 2])
def test_like_join_equals_brute_force(spark, monkeypatch, shapes):
    monkeypatch.setattr(patterns, "MAX_SHAPES", shapes)
    rng = random.Random(1)
    names = words(rng, "ab_c%", 150, 7)
    likes = words(rng, "ab_%", 120, 6) + ["a\\_b%", "\\%a%", "ab\\%%"]
    left = spark.createDataFrame([(n,) for n in names], "name string")
    right = spark.createDataFrame([(p,) for p in likes] + [(None,)], "pattern string")
    found = {tuple(r) for r in patterns.like_join(left, "name", right, "pattern").collect()}
    assert found == {(n, p) for n in names for p in likes if like_regex(p).fullmatch(n)}


def test_glob_join_equals_fnmatch(spark):
    rng = random.Random(2)
    names = words(rng, "ab_.1", 150, 7) + ["a[b", "a]", "a^b", "ab+c.csv", "A.csv"]
    globs = words(rng, "ab_.*%?", 120, 6) + ["[ab]*", "[!ab]*", "a[b", "a[b*", "[a-c]_%", "[^a]*", "ab+c%", "%.csv", "a]"]
    left = spark.createDataFrame([(n,) for n in names], "name string")
    right = spark.createDataFrame([(p,) for p in globs], "pattern string")
    found = {tuple(r) for r in patterns.glob_join(left, "name", right, "pattern").collect()}
    assert found == {(n, p) for n in names for p in globs if fnmatch.fnmatchcase(n, p.replace("%", "*"))}


def test_underscore_is_wildcard_in_like_only(spark, rows):
    name = spark.createDataFrame([("acmeXcustomer.csv",), ("acme_customer.csv",)], "name string")
    pattern = spark.createDataFrame([("acme_cust%",)], "pattern string")
    assert len(rows(patterns.like_join(name, "name", pattern, "pattern"))) == 2
    assert rows(patterns.glob_join(name, "name", pattern, "pattern"), "name") == [("acme_customer.csv",)]


def test_like_join_has_no_nested_loop(spark):
    name = spark.createDataFrame([("a1",)], "name string")
    pattern = spark.createDataFrame([("a%",)], "pattern string")
    plan = patterns.like_join(name, "name", pattern, "pattern")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_number_rows(spark, rows):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("t"))
    out = ordering.number_rows(df, [F.col("v")], "n", F.lit(41))
    assert rows(out, "v", "n") == sorted(((v, v + 41) for v in range(1000)), key=repr)
    empty = ordering.number_rows(df.filter("v < 0"), [F.col("v")], "n", F.lit(1))
    assert empty.count() == 0


def test_running_totals_descending(spark, rows):
    df = spark.range(500).select("id", (F.col("id") % 5).alias("a"), F.lit(1).alias("b"))
    out = ordering.running_totals(df, [F.desc("id")], {"a": "sum_a", "b": "sum_b"})
    want, total = {}, 0
    for i in reversed(range(500)):
        total += i % 5
        want[i] = (total, 500 - i)
    assert {r["id"]: (r["sum_a"], r["sum_b"]) for r in out.collect()} == want


def test_next_id(spark):
    table = spark.createDataFrame([(3,), (9,), (None,)], "id long")
    one = spark.range(1)
    assert one.select(ordering.next_id(table, "id")).first()[0] == 10
    assert one.select(ordering.next_id(table.filter("id > 99"), "id")).first()[0] == 1


def test_salted_join_with_hot_key(spark, rows):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    facts = facts.unionByName(spark.createDataFrame([(9999, None)], "id long, k long"))
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(40)], "k long, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(salted_join(facts, lookup, ["k"], ["id"], how), "id") == rows(facts.join(lookup, "k", how), "id")
    with pytest.raises(ValueError):
        salted_join(facts, lookup, ["k"], ["id"], "full")


def test_thinned_keeps_all_keys(spark, rows):
    keys = spark.range(1000).select((F.col("id") % 3).alias("k"))
    thin = thinned(keys)
    assert thin.count() <= 3 * keys.rdd.getNumPartitions()
    assert rows(thin.distinct()) == rows(keys.distinct())


def test_matching(spark, rows):
    table = spark.createDataFrame([("a", 1), (" a", 2), ("b", 3)], "k string, v int")
    keys = spark.createDataFrame([(" a ",), ("a",), ("zz",)], "k string")
    assert rows(matching(table, keys, "k", trim=True)) == [("a", 1)]
    assert matching(table, None, "k") is table
    with pytest.raises(ValueError):
        matching(table, keys, "v")


def test_beside_renames_clashes(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(1, "y", 2)], "id int, name string, n int")
    out = beside(a, b, "b_", {"id": "id"})
    assert out.columns == ["id", "name", "b_id", "b_name", "n"]
    assert tuple(out.first()) == (1, "x", 1, "y", 2)


def test_number_lines_over_many_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "small.txt").write_text("line 0\nline 1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        text = spark.read.text(str(tmp_path)).select(
            "value",
            F.col("_metadata.file_name").alias("f"),
            F.col("_metadata.file_block_start").alias("b"),
            F.monotonically_increasing_id().alias("at"),
        )
        out = ordering.number_lines(text, "f", "b", "at", "n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r["b"] for r in out if r["f"] == "big.txt"}) > 5
    assert sorted((r["f"], r["n"]) for r in out) == [("big.txt", i + 1) for i in range(5000)] + [("small.txt", 1), ("small.txt", 2)]
    assert all(r["value"] == f"line {r['n'] - 1}" for r in out)


def test_shared_folder(spark, rows):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = written(spark.range(5), "kept")
    assert rows(df) == [(i,) for i in range(5)]
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x") and not path_exists(spark, path)


def test_measured_join_with_hot_keys(spark, rows):
    facts = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 11).alias("k"))
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(5, 9)], "k long, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        for most in (30, 1000):
            joined = measured_join(facts, lookup, ["k"], ["id"], how, most)
            assert joined.columns == facts.join(lookup, "k", how).columns and rows(joined) == rows(facts.join(lookup, "k", how))
    with pytest.raises(ValueError):
        measured_join(facts, lookup, ["k"], ["id"], "full")
    assert measured_join(facts.limit(0), lookup, ["k"], ["id"]).count() == 0


def test_sieve_keeps_all_wanted_and_few_others(spark):
    every = spark.range(200_000).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"), F.col("id").alias("_bits"))
    wanted = every.filter("_bits % 40 = 0").select(F.col("name").alias("w"))
    found = likely(every.unionByName(spark.createDataFrame([(None, -1)], "name string, _bits long")), "name", wanted)
    assert found.columns == ["name", "_bits"]
    kept = {r["_bits"] for r in found.collect()}
    assert {k for k in range(0, 200_000, 40)} <= kept and len(kept) < 5000 + 200_000 / 12
    assert likely(every, "name", wanted.limit(0)).count() == 0
    assert sieve.sieve_size(0) == 1 << 15 and sieve.sieve_size(1 << 24) == 1 << 28 and sieve.sieve_size((1 << 24) + 1) is None
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
