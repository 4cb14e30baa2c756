"""Forged stores, routing, crowded windows, groups that take no part, many rules, versions, hierarchies, threats."""

import ipaddress
import random
import re
from collections import defaultdict, deque
from datetime import datetime, timedelta

import pytest
from factloom.functions.patterns import ALWAYS, ASKED, FILLED, participation, took_part
from factloom.operators import behavior, evolve, ingest, ledger, ontology, route, shared_rules, threats, versions
from factloom.plans.connector import DATABASE, KEY_VALUE, SSH, Condition, Connector, Rule, Signature
from factloom.sources import store
from factloom.sources.lines import spread
from factloom.streaming import timed
from factloom.streaming.pipeline import behavior_stream

from pyspark.sql import functions as F

START = datetime(2024, 1, 1)
FAILURE = '2024-01-01 00:00:0{} UTC [11] FATAL:  password authentication failed for user "admin"'


def observations(spark, lines, sources=None):
    rows = [(i, START + timedelta(seconds=i), sources[i] if sources else "test", x) for i, x in enumerate(lines)]
    return spark.createDataFrame(rows, "seq long, obs_ts timestamp, source string, raw string")


def test_forgeries_show(spark):
    facts = ledger.assign_lsn(ingest.facts(observations(spark, [FAILURE.format(i % 10) for i in range(20)]), DATABASE))
    low, size = ledger.BASE_LSN, 4
    sealed = ledger.seal(facts, size).checkpoint()
    anchors = ledger.chained(ledger.block_roots(sealed), "block").checkpoint()
    last = anchors.agg(F.max_by("anchor", "block")).first()[0]
    check = lambda x, a, **more: tuple(ledger.verify(x, a, size, **more).first())[:2]
    assert check(sealed, anchors, trusted=last) == ("INTEG_OK", 20) and check(sealed, anchors, trusted="x") == ("VIOLATED", 16)

    def forged(block):
        own = ledger.seal(ledger.tamper(sealed.filter(F.col("block") == block), low + 1 + block * size).drop(*ledger.INTEGRITY), size).select(*sealed.columns)
        return sealed.filter(F.col("block") != block).union(own).checkpoint()

    for block in (0, 2, 4):
        facts_now = forged(block)
        assert check(facts_now, None) == ("INTEG_OK", 20) and check(facts_now, anchors) == ("VIOLATED", block * size)
        roots = ledger.block_roots(facts_now).select("block", F.col("root").alias("new"))
        rewritten = anchors.join(roots, "block").withColumn("root", F.col("new")).drop("new").checkpoint()
        assert check(facts_now, rewritten) == ("VIOLATED", block * size)
        whole = ledger.chained(rewritten.drop("anchor"), "block").checkpoint()
        assert check(facts_now, whole) == ("INTEG_OK", 20) and check(facts_now, whole, trusted=last)[0] == "VIOLATED"
    assert check(sealed, anchors.withColumn("anchor", F.lit("x"))) == ("VIOLATED", 0)
    assert check(sealed.filter("block > 0"), None) == ("VIOLATED", 0) and check(sealed.filter("block > 0"), anchors) == ("VIOLATED", 0)
    assert check(sealed.filter("block != 2"), anchors) == ("VIOLATED", 8) and check(sealed, anchors.filter("block != 2")) == ("VIOLATED", 8)
    assert check(sealed, anchors.filter("block < 4")) == ("VIOLATED", 16) and check(sealed, anchors.union(anchors.filter("block = 1"))) == ("VIOLATED", 4)
    assert check(sealed.limit(0), anchors) == ("VIOLATED", 0) and check(sealed.limit(0), anchors.limit(0)) == ("INTEG_OK", 0)
    assert check(sealed.filter(F.col("lsn") != low + 10), anchors) == ("VIOLATED", 9)


def test_a_follower_refuses_what_is_broken(spark, tmp_path):
    facts = ingest.facts(observations(spark, [FAILURE.format(i) for i in range(9)]), DATABASE)
    leader, follower = f"{tmp_path}/leader", f"{tmp_path}/follower"
    store.append(facts, leader, block_facts=4)
    ledger.tamper(store.read(spark, leader), ledger.BASE_LSN + 6).write.parquet(f"{tmp_path}/bad/facts/append=1")
    store.anchors(spark, leader).write.parquet(f"{tmp_path}/bad/anchors")
    assert store.block_size(spark, leader) == 4 and store.catch_up(spark, f"{tmp_path}/bad", follower, ledger.BASE_LSN + 5)
    assert not store.catch_up(spark, f"{tmp_path}/bad", follower) and store.read(spark, follower).count() == 5
    assert store.catch_up(spark, leader, follower) and tuple(store.verify(spark, follower, 4).first())[:2] == ("INTEG_OK", 9)


def test_groups_that_take_no_part(spark):
    pattern = r"login(?: as (?P<user>\w+))?(?P<tail>\d*)(?:!(?P<mark>\w*))?[(]?"
    assert participation(pattern) == {"user": FILLED, "tail": ALWAYS, "mark": ASKED}
    lines = ["bob login", "bob login as eve", "bob login!", "bob login as eve7!x", "bob", "login login as eve!("]
    df = spark.createDataFrame([(x,) for x in lines], "raw string")
    for name in ("user", "tail", "mark"):
        got = [r[0] for r in df.select(took_part(F.col("raw"), pattern, name)).collect()]
        assert got == [bool(m) and m[name] is not None for m in (re.search(pattern, x) for x in lines)], name
    base = r"(?P<user>\w+) (?P<rest>.*)(?P<empty>x*)$"
    rule = lambda *when: Connector("c", 1.0, base, (Rule("hit", when, actor="${user}", target="${mark}"),), ())
    actors = lambda c: [r.actor for r in ingest.facts(observations(spark, lines), c).orderBy("seq").collect()]
    assert actors(rule(Condition("rest", matches=r"login(?: as (?P<user>\w+))?"))) == ["bob", "eve", "bob", "eve7", "login"][:4] + ["eve"]
    hits = lambda c: [r.rule_id for r in ingest.facts(observations(spark, lines), c).orderBy("seq").collect()]
    assert hits(rule(Condition("empty", equals=""))) == ["hit"] * 5
    marked = rule(Condition("rest", matches=r"login[^!]*(?:!(?P<mark>\w*))?"), Condition("mark", equals=""))
    assert hits(marked) == ["__unmatched__", "__unmatched__", "hit", "__unmatched__", "hit"]


def test_routing(spark):
    lines = [FAILURE.format(1), "<13> root failed password for db1 from 10.0.0.1", "USER=bob ACTION=drop STATUS=failed", FAILURE.format(2), "<13> a failed password for b from c", "junk", "junk", None, "USER=x", ""]
    sources = ["db", "edge", "app", "far", "far", "far", "db", "db", None, "app"]
    registry = route.Registry({"db": DATABASE, "edge": SSH, "app": KEY_VALUE}, (SSH, DATABASE))
    dealt = route.deal(observations(spark, lines, sources), registry).checkpoint()
    assert {(r.seq, r.knowledge_version, r.actor) for r in route.facts(dealt, registry).collect()} == {(0, "postgresql", "admin"), (1, "linux_sshd", "root"), (2, "keyvalue_generic", "bob"), (3, "postgresql", "admin"), (4, "linux_sshd", "a")}
    assert {(r.seq, r.reason) for r in route.unrouted(dealt).collect()} == {(5, "no_connector"), (6, "drift"), (7, "drift"), (8, "no_connector"), (9, "drift")}
    alone = ingest.facts(observations(spark, lines[:1], ["db"]), DATABASE).first()
    assert route.facts(dealt, registry).filter("seq = 0").first().asDict() == alone.asDict()
    plan = route.facts(route.deal(observations(spark, lines, sources), registry), registry)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    with pytest.raises(ValueError, match="linux_sshd"):
        route.Registry({"a": SSH, "b": Connector("linux_sshd", 1.0, None, (), ())}).connectors()
    assert route.facts(route.deal(observations(spark, lines, sources), route.Registry({})), route.Registry({}, (SSH,))).count() == 0


def test_crowded_windows_equal_a_queue(spark):
    rng = random.Random(3)
    rows = sorted((rng.randint(0, 60), i, rng.choice(["x", "x", "x", "y", None])) for i in range(400))
    df = spark.createDataFrame([(i, "hit" if i % 9 else "miss", a, t * 1_000_000, "c", "Low") for t, i, a in rows], "seq long, action string, actor string, system_timestamp long, class string, risk string")
    sig, other = Signature("s", "hit", 7, 4, "many", "High"), Signature("m", "miss", 20, 3, "misses", "Low")
    queues = defaultdict(deque)
    want = {}
    for t, i, a in rows:
        s = sig if i % 9 else other
        q = queues[a, s]
        q.append(t)
        while q[0] < t - s.window_secs:
            q.popleft()
        want[i] = (len(q), s.behavior_class if len(q) >= s.threshold else "c")
    for hot in (1, 30, 10_000):
        assert {r.seq: (r.window_count, r["class"]) for r in behavior.escalate(df, (sig, other), hot).collect()} == want
    same = df.withColumn("system_timestamp", F.lit(5).cast("long"))
    assert sorted(r.window_count for r in behavior.escalate(same.filter("actor = 'x' and action = 'hit'"), (sig,), 10).collect()) == list(range(1, same.filter("actor = 'x' and action = 'hit'").count() + 1))


def test_many_rules_equal_the_case(spark):
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "a", ""]

    def condition():
        kind = rng.randrange(6)
        field = rng.choice(["user", "message", "none", "got"])
        return [Condition(field, contains=rng.choice(words)), Condition(field, equals=rng.choice(words)), Condition(field, among=tuple(rng.sample(words, 2))), Condition(severity_in=(rng.choice(["LOG", "ERROR"]),)),
                Condition("message", matches=rng.choice([r"(?P<got>alpha)?", r"be(?P<got>\w*)", "^g"])), Condition()][kind]

    rules = tuple(Rule(f"r{i}", tuple(condition() for _ in range(rng.randint(1, 4))), action=rng.choice(["x", "${user}.y", " ${got} "]), actor=rng.choice([None, "${got}", "${user}"]), target="${message}", risk=rng.choice(["Low", "High"])) for i in range(120))
    many = Connector("many", 1.0, DATABASE.pattern, rules, ())
    lines = [f"2024-01-01 00:00:00 UTC [1] {rng.choice(['', 'alpha@db ', 'zed@db '])}{rng.choice(['LOG', 'ERROR', 'INFO'])}:  {' '.join(rng.choice(words) for _ in range(rng.randint(0, 3)))}" for _ in range(200)]
    parsed = ingest.parse(observations(spark, lines), many).checkpoint()
    got = [tuple(r.semantic) for r in shared_rules.classify(parsed, many).orderBy("seq").collect()]
    want = [tuple(r.semantic) for r in ingest.classify(parsed, many).orderBy("seq").collect()]
    assert got == want and len({g[0] for g in got}) > 5
    made = shared_rules.compiled(rules)
    assert len(made.conditions) == len(set(made.conditions)) < sum(len(r.when) for r in rules)
    none = Connector("none", 1.0, DATABASE.pattern, (), ())
    assert {r.semantic.rule_id for r in shared_rules.classify(parsed, none).collect()} == {"__unmatched__"}


def test_versions_of_a_connector(spark):
    new = Connector("kv2", 1.0, None, (Rule("kv_default", (), risk="High", actor="${USER}", target="${TARGET}"),), ())
    lines = ["USER=a STATUS=failed ACTION=drop TARGET=t", "USER=b", "no pairs"]
    both = versions.compared(observations(spark, lines), KEY_VALUE, new).checkpoint()
    assert {r.seq: r.change for r in both.collect()} == {0: "changed", 1: "changed", 2: "drift"}
    rows = {(r.change, r.old_rule, r.new_rule, r.old_risk, r.new_risk, r.lines, r.risk_step) for r in versions.difference(both).collect()}
    assert rows == {("changed", "kv_destructive_failure", "kv_default", "High", "High", 1, 0), ("changed", "kv_default", "kv_default", "Low", "High", 1, 2), ("drift", None, None, None, None, 1, None)}
    across = versions.compared(observations(spark, [*lines, FAILURE.format(1)]), KEY_VALUE, DATABASE)
    assert {r.seq: r.change for r in across.collect()} == {0: "lost", 1: "lost", 2: "drift", 3: "gained"}
    assert {r.change for r in versions.compared(observations(spark, lines), KEY_VALUE, KEY_VALUE).collect()} == {"same", "drift"}


def test_hierarchies(spark):
    edges = [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("f", None)]
    tree = spark.createDataFrame(edges, "class string, parent string")
    facts = spark.createDataFrame([(c,) for c in "deeefgg"] + [(None,)], "class string")
    got = {r["class"]: (r.level, r.own, r.total) for r in ontology.rolled_up(facts, tree).collect()}
    assert got == {"a": (0, 0, 4), "b": (1, 0, 4), "c": (1, 0, 4), "d": (2, 1, 4), "e": (3, 3, 3), "f": (0, 1, 1), "g": (0, 2, 2), "": (0, 1, 1)}
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(37)], "class string, parent string")
    assert ontology.closure(chain).count() == 38 * 39 // 2
    for loop in ([("a", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")]):
        with pytest.raises(ValueError, match="below itself"):
            ontology.closure(spark.createDataFrame(loop, "class string, parent string"))
    assert ontology.rolled_up(facts.limit(0), tree.limit(0)).count() == 0


def test_threats_by_brute_force(spark):
    rng = random.Random(5)
    ips = [f"10.{rng.randint(0, 1)}.{rng.randint(0, 3)}.{rng.randint(0, 255)}" for _ in range(60)] + ["999.1.1.1", "", None, "1.2.3", "::1", "255.255.255.255", "01.2.3.4"]
    nets = [f"10.{rng.randint(0, 1)}.{rng.randint(0, 3)}.{rng.randint(0, 255)}/{rng.choice([8, 15, 22, 24, 27, 31, 32])}" for _ in range(40)]
    rows = [(rng.choice("pq"), f"t{i % 9}", "range", v) for i, v in enumerate([*nets, "0.0.0.0/0", "10.0.0.1", "10.0.0.0/33", "x/8", "10.0.0.0/8/9", None])]
    rows += [("m", "T1", "action", "act"), ("m", "T2", "class", "cls"), ("m", "T1", "action", "act"), (None, "T3", "action", "act"), ("m", None, "action", "act"), ("m", "T4", "other", "act")]
    facts = [(i, rng.choice(["act", "no", None]), rng.choice(["cls", None]), ip, "mine") for i, ip in enumerate(ips * 2)]

    def tags(action, kind, ip):
        out = ({("m", "T1", "action")} if action == "act" else set()) | ({("m", "T2", "class")} if kind == "cls" else set())
        try:
            at = ipaddress.IPv4Address(ip) if ip and ip != "01.2.3.4" else None
        except ValueError:
            at = None
        for p in "pq" if at is not None else "":
            hit = []
            for provider, tag, k, value in rows:
                if provider == p and k == "range" and value and re.fullmatch(r"\d+(\.\d+){3}(/([0-9]|[12]\d|3[0-2]))?", value):
                    net = ipaddress.ip_network(value, strict=False)
                    hit += [(net.prefixlen, tag)] if at in net else []
            out |= {(p, t, "range") for n, t in hit if n == max(hit)[0]}
        return sorted(out)

    df = spark.createDataFrame(facts, "seq long, action string, class string, source_ip string, id string")
    table = spark.createDataFrame(rows, "provider string, tag string, kind string, value string")
    got = {r.seq: [tuple(t) for t in r.tags] for r in threats.tagged(df, table).collect()}
    assert got == {i: tags(a, c, ip) for i, a, c, ip, _ in facts}
    assert threats.tagged(df, table).columns == [*df.columns, "tags"] and threats.tagged(df, table.limit(0)).filter("size(tags) > 0").count() == 0
    assert threats.tag_counts(threats.tagged(df, table)).filter("tag = 'T2'").first().facts == sum(c == "cls" for _, _, c, _, _ in facts)


def test_sessions(spark):
    rows = [("a", 0, "x", "Low"), ("a", 3, "y", "Critical"), ("a", 14, "x", "Low"), (None, 1, "x", "odd"), ("b", 0, "x", "Medium"), ("b", 10, "x", "High"), ("b", 21, "y", "Low")]
    df = spark.createDataFrame([(a, START + timedelta(seconds=t), x, r) for a, t, x, r in rows], "actor string, obs_ts timestamp, action string, risk string")
    got = {(r.actor, (r.opened - START).seconds, (r.closed - START).seconds, r.facts, r.actions, r.worst) for r in behavior.sessions(df, "10 seconds").collect()}
    assert got == {("a", 0, 13, 2, "x,y", "Critical"), ("a", 14, 24, 1, "x", "Low"), ("unknown", 1, 11, 1, "x", None), ("b", 0, 20, 2, "x", "High"), ("b", 21, 31, 1, "y", "Low")}


def test_seeds_of_connectors(spark):
    lines = ["2024-01-01 00:00:00 UTC FW from 10.0.0.1 say \"no\" n=5 and 7 id=deadbeef", "FW (odd) [x] 12", "x" * 99 + " 3"]
    df = observations(spark, lines).select("seq", "raw")
    got = {r.template: r for r in evolve.cluster_report(df).collect()}
    for r in got.values():
        assert r.regex_valid and r.suggested_regex == evolve.suggest(r.template)
    one = got["FW (odd) [x] <NUM>"]
    assert one.suggested_regex == r"^FW\ \(odd\)\ \[x\]\ (?P<num1>\d+)$" and re.search(one.suggested_regex, lines[1])["num1"] == "12"
    assert all(len(r.sample) <= 90 for r in got.values())
    for c in (DATABASE, SSH, KEY_VALUE):
        cases = spark.createDataFrame(list(c.cases), "input string, expect_action string")
        assert tuple(ingest.coverage(cases, c).first()) == (len(c.cases), len(c.cases), 100.0)


def test_clusters_that_grow_equal_the_walk_over_all_lines(spark, tmp_path):
    rng = random.Random(9)
    lines = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(rng.randint(0, 6))) or "--- ;" for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, raw string")
    groups = evolve.template_groups(df).checkpoint()
    whole = {r.template: r.leader for r in evolve.leaders(groups).collect()}
    assert {r.template: r.leader for r in evolve.leaders(groups, piece=7).collect()} == whole
    for k, (low, high) in enumerate([(0, 40), (40, 100), (100, 150)]):
        batch = df.filter(f"seq >= {low} and seq < {high}")
        evolve.absorb(batch, f"{tmp_path}/clusters", k)
        if k == 1:  # a retry
            evolve.absorb(batch, f"{tmp_path}/clusters", k, piece=10)
    want = defaultdict(int)
    for x in lines:
        want[whole[x]] += 1
    got = {r.template: (r["count"], r.sample) for r in evolve.absorbed(spark, f"{tmp_path}/clusters").collect()}
    assert {t: n for t, (n, _) in got.items()} == want and all(s == t for t, (_, s) in got.items())
    evolve.absorb(df.limit(0), f"{tmp_path}/none", 0)
    assert evolve.absorbed(spark, f"{tmp_path}/none").count() == 0


def test_window_counts_run_on(spark):
    """One actor's crowd in one window: counts are those of a queue, and no frame slides, which would take the square of the crowd."""
    n = 20_000
    df = spark.range(n).select(F.col("id").alias("seq"), F.lit("hit").alias("action"), F.lit(None).cast("string").alias("actor"), (F.floor(F.col("id") / 3) * 1_000_000).cast("long").alias("system_timestamp"), F.lit("c").alias("class"), F.lit("Low").alias("risk"))
    out = behavior.escalate(df, (Signature("s", "hit", 2_500, 4, "many", "High"),))
    got = {r.seq: r.window_count for r in out.select("seq", "window_count").collect()}
    assert got == {i: i + 1 - 3 * max(0, i // 3 - 2_500) for i in range(n)}
    assert "RangeFrame" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_masks_are_tried_by_batch(spark):
    rules = tuple(Rule(f"r{i}", (Condition("message", contains=str(i)), Condition(severity_in=("ERROR",)))) for i in range(130))
    many = Connector("many", 1.0, DATABASE.pattern, rules, ())
    lines = [f"2024-01-01 00:00:00 UTC [1] {'ERROR' if i % 3 else 'LOG'}:  m {i}" for i in range(300)]
    out = shared_rules.classify(ingest.parse(observations(spark, lines), many), many).select("seq", "semantic.rule_id")
    want = {i: next((f"r{k}" for k in range(130) if str(k) in str(i)), "__unmatched__") if i % 3 else "__unmatched__" for i in range(300)}
    assert {r.seq: r.rule_id for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "zip_with(" not in plan


def test_tasks_grow_with_the_files(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert spread(df, 100).rdd.getNumPartitions() > spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(df, 100).count() == 1000


def test_state_is_kept_by_share(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id").alias("seq"), F.lit("hit").alias("action"), F.concat(F.lit("a"), F.col("id") % 2000).alias("actor"), (F.col("id") * 1000).alias("system_timestamp"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    made = behavior_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), Signature("s", "hit", 7, 2, "many", "High"))
    query = made.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.seq: r.window_count for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {i: 1 + i // 2000 for i in range(4000)}
    assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= timed.SHARES


def test_facts_are_shuffled_once_before_they_are_sealed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "CHUNK_FACTS", 8)
    facts = ingest.facts(observations(spark, [FAILURE.format(i % 10) for i in range(50)]), DATABASE).checkpoint()
    low = ledger.BASE_LSN
    for size, base in ((4, low), (4, low + 6), (20, low)):
        numbered, last = ledger.assign_lsn_by_chunk(facts, base=base, block_facts=size)
        want = ledger.seal(ledger.assign_lsn(facts, base=base), size)
        got = ledger.seal(numbered, size, placed=True)
        assert last == base + 50 and sorted(got.select("lsn", "seq", "leaf", "root").collect()) == sorted(want.select("lsn", "seq", "leaf", "root").collect())
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert ledger.assign_lsn_by_chunk(facts.withColumn("seq", F.lit(1).cast("long")), block_facts=4) is None
    path = f"{tmp_path}/s"
    for some in (facts.filter("seq < 13"), facts.filter("seq >= 13 and seq < 20"), facts.filter("seq > 90"), facts.filter("seq >= 20").withColumn("seq", F.lit(7).cast("long"))):
        store.append(some, path, block_facts=4)
    assert tuple(store.verify(spark, path, 4).first())[:2] == ("INTEG_OK", 50)


def test_pairs_of_templates_spread_over_tasks(spark):
    """Two token sets of many templates: their pairs come from many tasks and are those of a plain comparison."""
    rows = [(f"{'u' if i % 3 else 'v'} w x {i}", i) for i in range(120)]
    groups = spark.createDataFrame(rows, "template string, first_seq long")
    out = evolve.similar_templates(groups, 0.4, chunk=10)
    kind = lambda i: bool(i % 3)
    want = {(rows[i][0], rows[k][0]): 1.0 if kind(i) == kind(k) else 0.5 for i in range(120) for k in range(i + 1, 120)}
    got = out.collect()
    assert len(got) == len(want) and {(r.a, r.b): r.similarity for r in got} == want
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 8


def test_disk_of_pairs_of_templates_grows_with_templates(spark):
    """Four times the templates have 16 times the pairs, which aren't shuffled: what is written grows about four times."""

    def written(n: int) -> int:
        store, bus = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
        bus.waitUntilEmpty(30_000)
        before = store.executorList(True).head().totalShuffleWrite()
        groups = spark.createDataFrame([(f"{'u' if i % 3 else 'v'} w x {i}", i) for i in range(n)], "template string, first_seq long")
        evolve.similar_templates(groups, 0.4, chunk=10).write.format("noop").mode("overwrite").save()
        bus.waitUntilEmpty(30_000)
        return store.executorList(True).head().totalShuffleWrite() - before

    small, large = written(500), written(2000)
    assert 0 < large < 6 * small


def test_pairs_of_large_and_small_token_sets(spark):
    """Large sets with packs of their own and small ones that share packs: all pairs of a plain comparison, none twice.

    Templates that appear at once, or nobody knows when, aren't in order and have no pair.
    """
    words = ["w x a"] * 37 + ["w x b"] * 25 + ["w x"] * 11 + ["y z"] * 10 + [f"w {c} {d}" for c in "xyz" for d in "abcdefghi"] + ["", "", "q"]
    rows = [(f"{w} {i}", i * 7919 % 1009) for i, w in enumerate(words)]
    rows += [("w x a 900", rows[0][1]), ("w x c 901", rows[0][1]), ("w b 902", None), ("w x b 903", None)]
    sets = [frozenset(re.findall("[a-z]+", t)) or frozenset([""]) for t, _ in rows]
    want = {}
    for (a, at), s in zip(rows, sets, strict=True):
        for (b, bt), u in zip(rows, sets, strict=True):
            if at is not None and bt is not None and at < bt and len(s & u) >= 0.4 * len(s | u):
                want[a, b] = round(len(s & u) / len(s | u), 3)
    for chunk in (1, 10, 1000):
        got = evolve.similar_templates(spark.createDataFrame(rows, "template string, first_seq long"), 0.4, chunk=chunk, digits=3).collect()
        assert len(got) == len(want) and {(r.a, r.b): r.similarity for r in got} == want and all(r.sa < r.sb for r in got)
    assert evolve.similar_templates(spark.createDataFrame([], "template string, first_seq long")).count() == 0


def test_templates_of_one_token_set_stay_in_many_tasks(spark):
    """Nearly all templates have one token set: their leaders come from many tasks and no join by set deals them to one."""
    rows = [(f"u{i} w x y", i) for i in range(4000)] + [("u w x z", 4000), ("p q", 4001)]
    groups = spark.createDataFrame(rows, "template string, first_seq long").repartition(8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out, column, of_last in ((evolve.leaders(groups), "leader", "u0 w x y"), (evolve.similar_token_sets(groups)[1], "of", "u w x z")):
            got = out.select("template", column, F.spark_partition_id().alias("part")).collect()
            want = {t: "u0 w x y" for t, i in rows if i < 4000} | {"u w x z": of_last, "p q": "p q"}
            assert len(got) == len(rows) and {r.template: r[column] for r in got} == want
            parts = [r.part for r in got]
            assert max(map(parts.count, set(parts))) < 2500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_line_meets_its_pattern_once(spark):
    """What a connector finds in a line is computed once, for patterns and for keys and values."""
    lines = [FAILURE.format(1), "USER=bob ACTION=drop STATUS=failed", "junk", None]
    for connector, step in ((DATABASE, "regexp_replace("), (KEY_VALUE, "split(")):
        for registry in (route.Registry({"x": connector}), route.Registry({}, (connector,))):
            plan = route.deal(observations(spark, lines), registry)._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count(step) == 1
    plan = ingest.facts(observations(spark, lines), KEY_VALUE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_keys_and_values_of_odd_lines(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice("ab= =\t") for _ in range(rng.randint(0, 14))) for _ in range(300)] + ["", "=", "a==b =c a=", None]
    df = spark.createDataFrame([(x,) for x in lines], "raw string")
    want = [None if x is None else {c.split("=", 1)[0]: c.split("=", 1)[1] for c in x.split() if "=" in c} for x in lines]
    assert [r.m for r in df.select(ingest.key_values(F.col("raw")).alias("m")).collect()] == want


def test_no_task_has_most_rows_of_many_splits(spark, tmp_path):
    """One row group lies in one of many splits; events stored in few bytes are dealt by their number."""
    spark.range(250_000).coalesce(1).write.parquet(f"{tmp_path}/t")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = spark.read.parquet(f"{tmp_path}/t")
        assert df.rdd.getNumPartitions() > 8
        for out in (spread(df, 200_000), spread(df, 200_000, 10_000)):
            rows = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(rows) == 250_000 and max(rows) <= 100_000
        assert max(rows) <= 10_500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
