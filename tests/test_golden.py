"""Worked examples: sample lines, rules, windows against a queue, the ledger, the query language, drift."""

import json
import random
import shutil
from collections import defaultdict, deque
from datetime import datetime, timedelta, timezone

import pytest
from factloom.functions.patterns import captured, found, groups, strip
from factloom.operators import behavior, evolve, ingest, ledger, views
from factloom.operators.search import search
from factloom.plans.connector import DATABASE, KEY_VALUE, SSH, Connector, Signature, execution_order
from factloom.sources import artifact, store
from factloom.sources.lines import matrix_cases, text_lines

from pyspark.sql import functions as F

START = datetime(2024, 1, 1)
FAILURE = '2024-01-01 00:00:0{} UTC [11] FATAL:  password authentication failed for user "admin"'
LINES = [
    "2024-01-01 00:00:00 UTC [10] LOG:  database system is ready",
    *(FAILURE.format(i) for i in range(1, 6)),
    "2024-01-01 00:00:07 UTC [12] admin@prod LOG:  connection authorized: user=admin database=prod",
    "2024-01-01 00:00:08 UTC [12] admin@prod LOG:  statement: SELECT 1",
    "2024-01-01 00:00:09 UTC [13] guest@prod ERROR:  permission denied for table t",
]


def observations(spark, lines, step=1):
    rows = [(i, START + timedelta(seconds=i * step), "test", x) for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "seq long, obs_ts timestamp, source string, raw string")


def test_sample_log(spark):
    got = behavior.escalate(ingest.facts(observations(spark, LINES), DATABASE), DATABASE.signatures).orderBy("seq").collect()
    assert [r.action for r in got] == ["log.info", *["authentication.failure"] * 5, "authentication.success", "query.execute", "authorization.failure"]
    assert [r["class"] for r in got][1:6] == ["credential_attack"] * 4 + ["brute_force_attack"] and got[5].risk == "Critical"
    assert [(r.actor, r.target) for r in got][-3:] == [("admin", "prod"), ("admin", "prod"), ("guest", "prod")] and got[0].actor is None
    assert got[0].steps == ["parse", "normalize", "behavior", "emit"] and got[0].fact_id[14] == "7"


def test_other_connectors(spark):
    kv = ingest.facts(observations(spark, ["USER=bob ACTION=drop_table TARGET=payroll STATUS=failed", "USER=a=b ACTION=read USER=c", "no pairs", ""]), KEY_VALUE).orderBy("seq").collect()
    assert [(r.action, r.actor, r.target) for r in kv] == [("data.deletion.failure", "bob", "payroll"), ("log.info", "c", None)]
    ssh = ingest.facts(observations(spark, ["<13> root failed password for db1 from 10.0.0.1", "junk", None]), SSH).collect()
    assert [(r.action, r.actor, r.target, r.source_ip) for r in ssh] == [("authentication.failure", "root", "db1", "10.0.0.1")]
    assert Connector.from_json(DATABASE.to_json()) == DATABASE


def test_drift_is_all_that_does_not_parse(spark):
    obs = observations(spark, [*LINES, "noise", None, ""])
    parsed = ingest.parse(obs, DATABASE)
    assert ingest.quarantine(parsed).count() == 3 and parsed.filter("parsed").count() == 9


def test_execution_order():
    assert execution_order((("b", ("a",)), ("a", ()), ("c", ("a",)))) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        execution_order((("a", ("b",)), ("b", ("a",))))
    with pytest.raises(ValueError):
        execution_order((("a", ("z",)),))


def test_window_equals_a_queue(spark):
    rng = random.Random(3)
    rows = sorted((rng.randint(0, 60), i, rng.choice(["x", "y", None])) for i in range(300))
    df = spark.createDataFrame([(i, "hit", a, t * 1_000_000, "c", "Low") for t, i, a in rows], "seq long, action string, actor string, system_timestamp long, class string, risk string")
    sig = Signature("s", "hit", 7, 4, "many", "High")
    got = {r.seq: (r.window_count, r["class"]) for r in behavior.escalate(df, (sig,)).collect()}
    queues = defaultdict(deque)
    for t, i, a in rows:
        q = queues[a]
        q.append(t)
        while q[0] < t - 7:
            q.popleft()
        assert got[i] == (len(q), "many" if len(q) >= 4 else "c")


def test_ledger_finds_every_kind_of_damage(spark):
    facts = ledger.assign_lsn(ingest.facts(observations(spark, LINES), DATABASE))
    low = ledger.BASE_LSN
    for size in (4, 100):
        sealed = ledger.seal(facts, size).checkpoint()
        anchors = ledger.chained(ledger.block_roots(sealed), "block").checkpoint()
        check = lambda x: tuple(ledger.verify(x, anchors, size).first())[:2]  # noqa: B023, E731
        bad = lambda x: sorted(map(tuple, ledger.bad_facts(x, size).collect()))  # noqa: B023, E731
        assert [r.lsn for r in sealed.orderBy("lsn").select("lsn").collect()] == list(range(low + 1, low + 10))
        assert check(sealed) == ("INTEG_OK", 9) and check(ledger.tamper(sealed, low + 9)) == ("VIOLATED", 8)
        for column in set(ledger.SEALED) - {"lsn", "steps"}:
            kind = sealed.schema[column].dataType
            other = F.lit("x") if kind.typeName() == "string" else F.lit(START + timedelta(days=1)) if kind.typeName() == "timestamp" else F.lit(77)
            changed = sealed.withColumn(column, F.when(F.col("lsn") == low + 4, other.cast(kind)).otherwise(F.col(column)))
            assert bad(changed) == [(low + 4, "leaf")]
        assert bad(sealed.filter(F.col("lsn") != low + 6)) == [(low + 7, "gap")]
        assert bad(sealed.filter(F.col("lsn") != low + 4)) == [(low + 5, "gap")]  # a block's last fact when size is 4
        assert check(sealed.union(sealed.filter(F.col("lsn") == low + 3))) == ("VIOLATED", 2)
        assert check(sealed.filter(F.col("lsn") < low + 9))[0] == "VIOLATED"  # a lost tail
        wrong = sealed.withColumn("root", F.when(F.col("lsn") == low + 2, "x").otherwise(F.col("root")))
        assert bad(wrong) == [(low + 2, "root"), (low + 3, "root")]
        assert ledger.verify(sealed.limit(0)).first().facts == 0


def test_store_appends_recovers_and_verifies(spark, tmp_path):
    path = f"{tmp_path}/store"
    facts = ingest.facts(observations(spark, LINES), DATABASE)
    assert store.verify(spark, path).first().status == "ERROR"
    for k in range(3):
        store.append(facts.filter(F.col("seq") % 3 == k), path, batch_id=k, block_facts=4)
    store.append(facts, path, batch_id=2, block_facts=4)  # a retry
    whole = store.verify(spark, path, 4).first()
    assert (whole.status, whole.facts) == ("INTEG_OK", 9) and store.tail(spark, path)[0] == ledger.BASE_LSN + 9
    assert store.anchors(spark, path).agg(F.sum("facts")).first()[0] == 9
    copy, other = f"{tmp_path}/copy", f"{tmp_path}/diverged"
    assert store.catch_up(spark, path, copy, ledger.BASE_LSN + 3) and store.catch_up(spark, path, copy)
    assert tuple(store.verify(spark, copy, 4).first())[:2] == ("INTEG_OK", 9)
    store.append(facts.filter("seq > 5"), other, block_facts=4)
    assert not store.catch_up(spark, path, other)
    orphan = store.read(spark, path).withColumn("lsn", F.col("lsn") + 9)  # facts without anchors, as a failed append leaves them
    orphan.write.parquet(f"{path}/facts/append={ledger.BASE_LSN + 10}")
    assert store.read(spark, path).count() == 9 and store.verify(spark, path, 4).first().status == "INTEG_OK"
    spark.range(3).write.parquet(f"{tmp_path}/other/facts")
    assert store.verify(spark, f"{tmp_path}/other").first().status == "CORRUPTED"
    ledger.tamper(store.read(spark, path), ledger.BASE_LSN + 5).write.parquet(f"{tmp_path}/bad/facts/append=1")
    store.anchors(spark, path).write.parquet(f"{tmp_path}/bad/anchors")
    bad = store.verify(spark, f"{tmp_path}/bad", 4).first()
    assert (bad.status, bad.facts) == ("VIOLATED", 4)


def test_search(spark):
    facts = ledger.assign_lsn(ingest.facts(observations(spark, LINES), DATABASE))
    assert search(facts, ("lsn", "actor.name", "lsn"), "authentication.failure", "postgresql").columns == ["actor.name", "lsn"]
    assert search(facts, ("lsn",)).count() == 9 and search(facts, ("no",), target="prod").first()["no"] is None
    assert search(facts, ("fact.behavior",), "query.execute").first()[0].risk_level == "Low"
    assert search(facts, ("fact.integrity",), "query.execute").first()[0].signature is None
    assert search(facts, ("lsn",), target="").count() == 1
    now = int(datetime(2024, 1, 1, 0, 1, 4, tzinfo=timezone.utc).timestamp() * 1_000_000)
    assert search(facts, ("lsn",), within=(1, "minutes"), as_of_micros=now).count() == 5


def test_one_pass_gives_what_a_pass_for_each_group_gives(spark):
    rows = [(x,) for x in [*LINES, "noise", None, "", LINES[1] + "\x01", "\x02" + LINES[7], "\u2003" + LINES[6] + " \x85"]]
    df = spark.createDataFrame(rows, "raw string").select(strip(F.col("raw")).alias("raw"))
    got, names = captured(F.col("raw"), DATABASE.pattern)
    each = groups(F.col("raw"), DATABASE.pattern)
    for r in df.select(got.alias("got"), found(F.col("raw"), DATABASE.pattern).alias("found"), F.struct(*(c.alias(n) for n, c in each.items())).alias("each")).collect():
        assert (r.got is not None) == bool(r.found) and (not r.got or [g or None for g in r.got] == [r.each[n] for n in names])


def test_artifacts_and_their_test_matrix(spark, tmp_path):
    connector = Connector.from_json(json.dumps({**json.loads(DATABASE.to_json()), "cases": [(LINES[1], "authentication.failure"), (LINES[8], "log.info"), ("junk", "")]}))
    artifact.save(spark, connector, f"{tmp_path}/db")
    assert artifact.load(spark, f"{tmp_path}/db") == connector
    cases = matrix_cases(spark, f"{tmp_path}/db/test_matrix")
    assert tuple(ingest.coverage(cases, DATABASE).first())[:2] == (3, 1)
    artifact.save(spark, connector, f"{tmp_path}/half")
    shutil.rmtree(f"{tmp_path}/half/behavior")
    with pytest.raises(FileNotFoundError, match="behavior"):
        artifact.load(spark, f"{tmp_path}/half")
    spark.createDataFrame([("a",), ("",), ("b",)], "value string").coalesce(1).write.text(f"{tmp_path}/lines")
    assert [r.raw for r in text_lines(spark, f"{tmp_path}/lines").orderBy("seq").collect()] == ["a", "b"]


def test_leaders_equal_the_greedy_walk(spark):
    rng = random.Random(5)
    lines = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(rng.randint(0, 6))) or "--- ;" for _ in range(120)] + ["--- ; ---", "*** ### ***", "== =="]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, raw string")
    seen, want = [], {}
    for x in dict.fromkeys(lines):
        t = set(x.split()) if any(c.isalpha() for c in x) else set()
        near = (l for l, u in seen if (len(t & u) / len(t | u) if t | u else 1.0) >= 0.6)  # noqa: E741
        want[x] = next(near, x)
        if want[x] == x:
            seen.append((x, t))
    assert {r.template: r.leader for r in evolve.leaders(evolve.template_groups(df)).collect()} == want


def test_clusters_and_entropy(spark):
    lines = ["FW devid=1 action=deny", "FW devid=2 action=allow", "FW devid=3 action=deny", "HR|user=a|op=x", "HR|user=b|op=y", "lone line"]
    drift = observations(spark, lines).select("seq", "raw")
    report = evolve.cluster_report(drift).collect()
    assert [r["count"] for r in report] == [3, 2, 1] and report[0].coverage_pct == 50.0
    assert evolve.entropy(evolve.template_groups(drift)).first().entropy == 1.459
    assert evolve.entropy(evolve.template_groups(drift.limit(0))).first().entropy == 0.0


def test_replicas(spark):
    a = spark.createDataFrame([(i, f"r{i}") for i in range(9)], "lsn long, root string")
    b = a.filter("lsn < 5")
    assert views.missing_range(a, b).count() == 4 and views.divergence(a, b).first().lsn is None
    assert views.accepts(b, 4, "r4").first().accepted and not views.accepts(b, 4, "x").first().accepted
