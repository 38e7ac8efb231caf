"""Runs, numbered inputs, digests, observed audits, committed sinks and SQL functions."""

import random

import pytest
from pyspark.sql import functions as F

from brute import exclusive_brute
from solospan import app
from solospan.functions.buckets import bucket_of
from solospan.functions.ipv4 import ip4_text, parse_ip4
from solospan.functions.sql import register_sql_functions
from solospan.operators import audit, cutting, events, exclusive, sets
from solospan.plans.scan import scan_plan
from solospan.sources.committed import CommittedTable
from solospan.streaming.publish import publish, publish_files

SCHEMA = "set_id bigint, begin bigint, end bigint"


def nulls_first(r):
    return tuple((x is not None, x) for x in r)


def runs_brute(rows, keyed):
    groups = {}
    for k, seq, value in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(k if keyed else 0, []).append((seq, value))
    out = []
    for k, group in groups.items():
        runs = []
        for seq, value in group:
            if runs and runs[-1][0] == value:
                runs[-1][1].append(seq)
            else:
                runs.append((value, [seq]))
        out += [(*([k] if keyed else []), i + 1, v, len(s), s[0], s[-1]) for i, (v, s) in enumerate(runs)]
    return sorted(out, key=nulls_first)


@pytest.mark.parametrize("strategy", ["window", "bucketed"])
@pytest.mark.parametrize("keyed", [True, False])
def test_consecutive_runs(spark, strategy, keyed):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 0, 0, 0, 1]), i * 3, rnd.choice(["a", "a", "b", None])) for i in range(500)]
    rows += [(2, 2000 + i, "c") for i in range(300)]  # one run over many partitions
    df = spark.createDataFrame(rows, "set_id bigint, at bigint, v string")
    got = events.consecutive_runs(df, "at", "v", ["set_id"] if keyed else [], strategy=strategy, target_rows=30)
    assert got.columns == [*(["set_id"] if keyed else []), "run", "v", "length", "first_at", "last_at"]
    assert sorted(map(tuple, got.collect()), key=nulls_first) == runs_brute(rows, keyed)
    assert events.consecutive_runs(df.limit(0), "at", "v", strategy=strategy).count() == 0


def test_consecutive_runs_shuffle_once(spark):
    df = spark.range(100).selectExpr("id % 3 as set_id", "id as at", "id div 10 as v")
    plan = events.consecutive_runs(df, "at", "v", strategy="window")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# many files in one plan


def write_files(folder, n):
    folder.mkdir()
    for i in range(n):
        (folder / f"f{i:03}.txt").write_text("" if i == 1 else f"1.0.0.{i}, 1.0.0.{i + 9}\n1.0.0.{i + 5}, 1.0.0.{i + 20}\nbad {i}\n")
    return str(folder)


def jobs_of(spark, group, f):
    spark.sparkContext.setJobGroup(group, group)
    out = f()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n, out


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    few, many = write_files(tmp_path / "few", 3), write_files(tmp_path / "many", 25)
    n_few, _ = jobs_of(spark, "few", lambda: publish_files(spark, few, f"{tmp_path}/a"))
    n_many, numbers = jobs_of(spark, "many", lambda: publish_files(spark, many, f"{tmp_path}/b", first=5))
    assert 0 < n_many <= n_few + 1
    got = sorted((r.source.rsplit("/", 1)[1], r.set_id) for r in numbers.collect())
    named = [i for i in range(25) if i != 1]  # a file without a byte is no source
    assert got == [(f"f{i:03}.txt", 5 + n) for n, i in enumerate(named)]
    base = 16777216
    want = exclusive_brute([(5 + n, base + i + a, base + i + b) for n, i in enumerate(named) for a, b in ((0, 9), (5, 20))])
    out = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/b/output").select("set_id", "begin", "end")
    assert sorted(map(tuple, out.collect())) == want
    assert spark.read.parquet(f"{tmp_path}/b/rejects").where("reason = 'malformed'").count() == 24


def test_application_over_a_folder(spark, tmp_path):
    files, tables = write_files(tmp_path / "in", 4), str(tmp_path / "tables")
    (tmp_path / "in" / "f003.txt").write_text("nothing good\n")
    assert app.run_files(spark, files, tables, listing=f"{tmp_path}/listing") == [1, 2, 3]
    assert app.first_free_set_id(spark, f"{tables}/input") == 4  # the last set has no rows
    assert app.run_files(spark, files, tables) == [4, 5, 6]
    out = spark.read.schema(SCHEMA).parquet(f"{tables}/output")
    assert out.where("set_id = 5").count() == out.where("set_id = 2").count() == 2
    assert spark.read.text(f"{tmp_path}/listing").where("set_id = 1").count() == 2


def test_number_sets(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4)], "source string, set_id bigint")
    got = {r.source: r.set_id for r in sets.number_sets(rows.drop("set_id"), first=sets.next_set_id(rows)).collect()}
    assert got == {None: 5, "a": 6, "b": 7}
    assert sets.number_sets(rows, first=10).columns == ["set_id", "source"]
    assert sets.number_sets(rows.limit(0)).count() == 0


# digests


def test_planted_differences_are_found(spark):
    rnd = random.Random(6)
    rows = [(rnd.randrange(4), b := rnd.randrange(10_000), b + 3) for _ in range(3000)]
    left = spark.createDataFrame(rows + [(None, 5, 6)], SCHEMA)
    changed = [*rows[:10], (rows[10][0], rows[10][1], rows[10][2] + 1), *rows[11:], rows[20], (None, 5, 6)]
    right = spark.createDataFrame(random.Random(1).sample(changed, len(changed)), SCHEMA).repartition(7)
    cell = {"set_id": F.col("set_id"), "bucket": bucket_of("begin", 64)}
    got, want = sets.cross_check_digest(left, right, cell), sets.cross_check(left, right)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() == 3
    cells = sets.compared_cells(left, right, cell).where("differs").collect()
    assert {(r.set_id, r.bucket) for r in cells} == {(rows[i][0], rows[i][1] // 64) for i in (10, 20)}
    assert sets.cross_check_digest(left, left.repartition(3), cell).count() == 0
    moved = spark.createDataFrame([(0, 1, 2), (0, 3, 3)], SCHEMA), spark.createDataFrame([(0, 1, 3), (0, 3, 2)], SCHEMA)
    assert sets.cross_check_digest(*moved, {"set_id": F.col("set_id")}).count() == 4
    total = sets.digest_summary(left, right, cell).agg(F.sum("rows_left"), F.sum("rows_right"), F.sum("cells_differing")).first()
    assert tuple(total) == (3001, 3002, 2)


def test_only_differing_cells_are_compared_row_by_row(spark):
    df = spark.range(1000).selectExpr("id % 5 as set_id", "id as begin", "id + 1 as end")
    cell = {"set_id": F.col("set_id"), "bucket": bucket_of("begin", 100)}
    other = df.where("begin <> 250")
    plan = sets.cross_check_digest(df, other, cell)
    plan.collect()
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


# observed audits


def test_observed_numbers_equal_the_audit(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(rnd.randrange(5), b := rnd.randint(0, 300), b + rnd.randint(0, 30)) for _ in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    for kw in ({}, {"strategy": "bucketed", "target_rows": 50}):
        result, seen = audit.observed_exclusive_ranges(df, **kw)
        result.write.mode("overwrite").parquet(f"{tmp_path}/out")
        written = spark.read.parquet(f"{tmp_path}/out")
        assert sorted(map(tuple, written.select("set_id", "begin", "end").collect())) == exclusive_brute(rows)
        a = audit.balance_audit(df).agg(F.sum("n_ranges"), F.sum("n_ends"), F.sum("n_points"), F.min("min_level"), F.sum("final_level")).first()
        assert tuple(seen.get[k] for k in ("n_ranges", "n_ends", "n_points", "min_level", "final_level")) == tuple(a)
        assert seen.get["n_exclusive"] == written.count()
    rows, seen = audit.observed_intervals(spark.createDataFrame([(0, 5, 3), (0, None, 2), (0, 1, 1)], SCHEMA))
    rows.write.mode("overwrite").parquet(f"{tmp_path}/rows")
    assert seen.get == {"n_rows": 3, "reversed": 1, "null": 1}


def test_presorted_check_rides_on_the_sweep(spark):
    rnd = random.Random(4)
    rows = [(s, i, b, b + rnd.randint(0, 9)) for s in range(3) for i, b in enumerate(sorted(rnd.randint(0, 60) for _ in range(50)))]
    df = spark.createDataFrame(rows, "set_id bigint, seq bigint, begin bigint, end bigint")
    out = exclusive.exclusive_ranges_presorted(df, "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan") == 1
    assert sorted(map(tuple, out.collect())) == exclusive_brute([(s, b, e) for s, _, b, e in rows])
    for bad in ((0, 7, 61, 70), (2, 60, 0, 1)):
        swapped = spark.createDataFrame([r for r in rows if r[:2] != bad[:2]] + [bad], df.schema)
        for target in (None, 20):
            with pytest.raises(Exception, match="Order violation"):
                exclusive.exclusive_ranges_presorted(swapped, "seq", target_rows=target).count()


# committed sinks


def test_publishing_into_committed_tables(spark, tmp_path, monkeypatch):
    schema = "begin bigint, end bigint, set_id int"
    kept, out = CommittedTable(spark, f"{tmp_path}/in", schema), CommittedTable(spark, f"{tmp_path}/out", schema)
    one = spark.createDataFrame([(1, 9), (5, 6)], "begin bigint, end bigint")
    publish(one, 3, kept, out)
    assert sorted((r.begin, r.end) for r in out.read().collect()) == [(1, 4), (7, 9)]
    reader = out.read()
    with monkeypatch.context() as m:  # the writer dies between writing and committing
        m.setattr(out, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            publish(spark.createDataFrame([(1, 2)], "begin bigint, end bigint"), 3, kept, out)
    assert out.read().count() == 2 and reader.count() == 2
    publish(spark.createDataFrame([(1, 2)], "begin bigint, end bigint"), 3, kept, out)
    publish(one, 4, kept, out)
    assert out.read(["set_id=3"]).count() == 1 and out.read().count() == 3 and kept.read().count() == 3


# SQL functions


def test_sql_functions_agree_with_the_columns(spark):
    register_sql_functions(spark, "t_")
    texts = ["1.2.3.4.", "+1.2.3.4", "\t1.2.3.4 ", "-0.2.3.4", "300.1.1.1", "1. 2.3.4", "1..3.4", "", None, "255.255.255.255", "x\n1.2.3.4", "1.2.3.4\u0085"]
    df = spark.createDataFrame([(t, i * 99999999 - 5) for i, t in enumerate(texts * 5)], "a string, v bigint")
    df.createOrReplaceTempView("t_rows")
    got = spark.sql("select t_ip4_value(a) p, t_ip4_text(v) s, t_bucket_of(v, 1000) b, t_left_of_edge(v, 8) l, t_right_of_edge(v, 8) r from t_rows")
    want = df.select(parse_ip4("a").alias("p"), ip4_text("v").alias("s"), bucket_of("v", 1000).alias("b"), (F.col("v") * 8 - 1).alias("l"), (F.col("v") * 8).alias("r"))
    assert got.collect() == want.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "t_ip4" not in plan


# results carry a bound of their rows


def test_merging_results_runs_no_planning_job(spark):
    df = spark.createDataFrame([(0, 1, 5), (0, 6, 9), (1, 2, 2)], SCHEMA)
    results = exclusive.exclusive_ranges(df)
    n, merged = jobs_of(spark, "merge", lambda: cutting.merge_touching(results))
    assert n == 0 and sorted(map(tuple, merged.collect())) == [(0, 1, 9), (1, 2, 2)]
    assert scan_plan(df, ["set_id"], "begin", n_rows=10) is None
