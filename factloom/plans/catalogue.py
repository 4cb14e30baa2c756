"""Queries over the driver's tables, by name, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.patterns import groups, strip
from factloom.operators import behavior, evolve, ingest, ledger, ontology, route, shared_rules, threats, versions, views
from factloom.operators.search import nested, search
from factloom.plans.connector import DATABASE, KEY_VALUE, SSH, Condition, Connector, Rule, Signature
from factloom.sources import artifact, store
from factloom.sources.lines import event_line, event_lines, matrix_cases, spread, text_lines
from factloom.sources.shared import exists, scratch, shared_folder
from factloom.streaming import timed
from factloom.streaming.pipeline import behavior_stream, clusters_to, ingest_to

#: Sixty seconds never hold five failures of one user in the events table; a week does.
WEEK = Signature("week_brute_force", "authentication.failure", 604_800, 5, "brute_force_attack", "Critical")
DAY = Signature("day_brute_force", "authentication.failure", 86_400, 2, "repeated_failure", "Medium")
#: What windows and their queries read of a fact; where watched facts are written first, no more is made and written.
FACT = ("seq", "rule_id", "action", "class", "risk", "actor", "target", "system_timestamp")
TAMPERED = ledger.BASE_LSN + 700


BLOCK = 500


def _obs(spark: SparkSession, d: str) -> DataFrame:
    return event_lines(spread(spark.read.parquet(f"{d}/events.parquet")))


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return ingest.facts(_obs(spark, d), DATABASE)


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    return ledger.assign_lsn(_facts(spark, d))


def _sealed(spark: SparkSession, d: str) -> DataFrame:
    return ledger.seal(_numbered(spark, d), BLOCK)


def _caught_up(spark: SparkSession, d: str) -> DataFrame:
    """Verification of a follower that takes over 700 facts, then the rest."""
    path = shared_folder(spark, "follower")
    for upto in (TAMPERED, None):
        if not store.catch_up(spark, _store(spark, d), path, upto):
            raise RuntimeError("the follower refused its leader's facts")
    return store.verify(spark, path, BLOCK).select("status", "facts")


_stores: dict[tuple[str, str], str] = {}


def _append(spark: SparkSession, d: str) -> str:
    """A new store of all facts, in the shared folder."""
    path = shared_folder(spark, "store")
    store.append(_facts(spark, d), path, block_facts=BLOCK)
    return path


def _store(spark: SparkSession, d: str) -> str:
    """The store that queries on stored facts share; filled once in an application for each input."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _stores:
        _stores[key] = _append(spark, d)
    return _stores[key]


def _stored(spark: SparkSession, d: str) -> DataFrame:
    return store.read(spark, _store(spark, d))


def _now(facts: DataFrame) -> int:
    return facts.agg(F.max("system_timestamp")).first()[0] or 0


def _ask(fields: str, action: str = "*", target: str = "*", within: tuple[int, str] | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        facts = _stored(spark, d)
        return search(facts, tuple(fields.split(", ")), action, target, within, _now(facts) if within else None)

    return run


def _check(change: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Verification of the stored facts after a change, against the store's anchors."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        path = _store(spark, d)
        return ledger.verify(change(store.read(spark, path)), store.anchors(spark, path), BLOCK).select("status", "facts")

    return run


def _reforged(spark: SparkSession, d: str) -> DataFrame:
    """Verification after one fact was changed, its block sealed anew and its anchor row given the new root."""
    path = _store(spark, d)
    facts, anchors = store.read(spark, path), store.anchors(spark, path)
    own = (TAMPERED - ledger.BASE_LSN - 1) // BLOCK
    forged = ledger.seal(ledger.tamper(facts.filter(F.col("block") == own), TAMPERED).drop(*ledger.INTEGRITY), BLOCK).select(*facts.columns)
    roots = ledger.block_roots(forged).select("block", F.col("root").alias("forged"))
    rows = anchors.join(roots, "block", "left").withColumn("root", F.coalesce("forged", "root")).drop("forged")
    return ledger.verify(facts.filter(F.col("block") != own).union(forged), rows, BLOCK).select("status", "facts")


def _reanchored(spark: SparkSession, d: str) -> DataFrame:
    """Verification after the anchors from the second block on were overwritten."""
    path = _store(spark, d)
    rows = store.anchors(spark, path).withColumn("anchor", F.when(F.col("block") > 0, "x").otherwise(F.col("anchor")))
    return ledger.verify(store.read(spark, path), rows, BLOCK).select("status", "facts")


def _ssh(spark: SparkSession, d: str) -> DataFrame:
    e = spread(spark.read.parquet(f"{d}/events.parquet"))
    user = F.col("user_id").cast("string")
    raw = F.concat(F.lit("<13> u"), user, F.lit(" failed password for db"), user, F.lit(" from 10.0.0."), (F.col("user_id") % 200).cast("string"))
    return ingest.facts(e.select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("obs_ts"), F.lit("ssh").alias("source"), raw.alias("raw")), SSH)


def _kv(spark: SparkSession, d: str) -> DataFrame:
    e = spread(spark.read.parquet(f"{d}/events.parquet"))
    bad = F.col("event_type") == "error"
    raw = F.concat(F.lit("USER=u"), F.col("user_id").cast("string"), F.when(bad, F.lit(" ACTION=drop_table STATUS=failed TARGET=t")).otherwise(F.lit(" ACTION=read STATUS=ok TARGET=t")), (F.col("event_id") % 9).cast("string"))
    return ingest.facts(e.select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("obs_ts"), F.lit("kv").alias("source"), raw.alias("raw")), KEY_VALUE)


def _providers(spark: SparkSession, d: str) -> DataFrame:
    """Indicators of three providers, of which one has nested ranges of the addresses that _ssh gives to users."""
    x = spark.read.parquet(f"{d}/events.parquet").select((F.col("user_id") % 200).alias("x")).distinct()
    host, block = F.col("x").cast("string"), F.floor(F.col("x") / 16)
    at = lambda name, tag, kind, value: F.struct(F.lit(name).alias("provider"), tag.alias("tag"), F.lit(kind).alias("kind"), value.alias("value"))
    some = lambda cond, row: F.when(cond, row)
    rows = F.array(
        some(F.col("x") % 10 == 0, at("ranges", F.concat(F.lit("host"), host), "range", F.concat(F.lit("10.0.0."), host))),
        some(block % 2 == 0, at("ranges", F.concat(F.lit("block"), block.cast("string")), "range", F.concat(F.lit("10.0.0."), (block * 16).cast("string"), F.lit("/28")))),
        at("ranges", F.lit("net"), "range", F.lit("10.0.0.0/25")), at("other", F.lit("ten"), "range", F.lit("10.0.0.0/8")), at("other", F.lit("broken"), "range", F.lit("10.0.0.999/40")),
        at("attack", F.lit("T1110"), "action", F.lit("authentication.failure")), at("attack", F.lit("TA0006"), "class", F.lit("credential_attack")), at("attack", F.lit("T9999"), "action", F.lit("none")),
    )
    return x.select(F.explode(rows).alias("r")).filter("r is not null").select("r.*")


def _reports(d: DataFrame) -> DataFrame:
    """Tags as one text, since arrays of structs compare badly."""
    one = F.transform("tags", lambda t: F.concat_ws("/", t["provider"], t["tag"], t["kind"]))
    return d.select("seq", "source_ip", F.array_join(one, ",").alias("tags"))


#: The database connector's next version: another pattern (pids of up to four digits), a rule less, one with another risk.
NEXT = replace(
    DATABASE, name="postgresql_next", pattern=DATABASE.pattern.replace(r"(?P<pid>\d+)", r"(?P<pid>\d{1,4})"),
    rules=tuple(replace(r, risk="High", behavior_class="privilege_escalation") if r.id == "pg_permission_denied" else r for r in DATABASE.rules if r.id != "pg_statement"),
)
#: Five hundred rules of two conditions each, of which most occur in many rules.
MANY = Connector(
    "many", 1.0, DATABASE.pattern,
    tuple(Rule(f"r{i}", (Condition("message", contains=f"{i % 250}"), Condition(severity_in=("ERROR", "FATAL") if i < 250 else ("LOG",))), action=f"seen.{i % 7}", actor="${user}") for i in range(499, -1, -1)), (),
)


def _ways(spark: SparkSession, d: str) -> DataFrame:
    """A hierarchy over all numbers up to the largest user's: each lies below its half."""
    top = spark.read.parquet(f"{d}/events.parquet").agg(F.max("user_id").alias("most"))
    return top.select(F.explode(F.sequence(F.lit(1), "most")).alias("class")).select("class", F.nullif(F.floor(F.col("class") / 2), F.lit(0)).alias("parent"))


#: Three connectors by source; lines of unknown sources are offered to two of them.
REGISTRY = route.Registry({"db": DATABASE, "edge": SSH, "app": KEY_VALUE}, (DATABASE, SSH))
WATCH = {"postgresql": (WEEK,), "linux_sshd": (Signature("ssh_week", "authentication.failure", 604_800, 4, "brute_force_attack", "Critical"),), "keyvalue_generic": (Signature("kv_week", "data.deletion.failure", 604_800, 3, "sabotage_attempt", "Critical"),)}


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    """The events as lines of several sources: of three kinds, with garbage, from known sources and from one that isn't."""
    e = spread(spark.read.parquet(f"{d}/events.parquet"))
    user, k = F.col("user_id").cast("string"), F.col("event_id") % 7
    ssh = F.concat(F.lit("<13> u"), user, F.lit(" failed password for db"), user, F.lit(" from 10.0.0."), (F.col("user_id") % 200).cast("string"))
    kv = F.concat(F.lit("USER=u"), user, F.when(F.col("event_type") == "error", F.lit(" ACTION=drop_table STATUS=failed TARGET=t")).otherwise(F.lit(" ACTION=read STATUS=ok TARGET=t")), (F.col("event_id") % 9).cast("string"))
    raw = F.when(k.isin(0, 1, 4), event_line()).when(k.isin(2, 5), ssh).otherwise(kv)
    source = F.when(k.isin(0, 1), "db").when(k == 2, "edge").when(k == 3, "app").otherwise("unknown")
    return e.select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("obs_ts"), source.alias("source"), raw.alias("raw"))


def _dealt(spark: SparkSession, d: str) -> DataFrame:
    return route.deal(_mixed(spark, d), REGISTRY)


def _drift(spark: SparkSession, d: str) -> DataFrame:
    return ingest.quarantine(ingest.parse(_obs(spark, d), DATABASE)).select("seq", "raw")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return _obs(spark, d).select("seq", "raw")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    got = groups(strip(F.col("raw")), DATABASE.pattern)
    return ingest.parse(_obs(spark, d), DATABASE).filter("parsed").select("seq", *(F.col("tokens")[n].alias(n) for n in got))


def _key_values(spark: SparkSession, d: str) -> DataFrame:
    t = ingest.parse(_obs(spark, d), KEY_VALUE).filter("parsed")
    return t.select("seq", F.try_element_at("tokens", F.lit("k")).alias("k"), F.try_element_at("tokens", F.lit("user")).alias("user"), F.try_element_at("tokens", F.lit("database")).alias("database"))


def _follower(spark: SparkSession, d: str, name: str) -> str:
    """A store filled apart from the leader's: ``whole`` and ``behind`` by taking over its facts, all of them or 900, and
    ``apart`` by facts of its own, one of which differs."""
    key = (spark.sparkContext.applicationId, f"{name} {d}")
    if key not in _stores:
        path, leader = shared_folder(spark, f"follower-{name}"), _store(spark, d)
        if name == "apart":
            odd = F.lit((store.read(spark, leader).filter(F.col("lsn") == TAMPERED).select("seq").first() or (-1,))[0])
            store.append(_facts(spark, d).withColumn("risk", F.when(F.col("seq") == odd, "None").otherwise(F.col("risk"))), path, block_facts=BLOCK)
        elif not store.catch_up(spark, leader, path, ledger.BASE_LSN + 900 if name == "behind" else None):
            raise RuntimeError("the follower refused its leader's facts")
        _stores[key] = path
    return _stores[key]


def _replicas(spark: SparkSession, d: str, name: str = "behind") -> tuple[DataFrame, DataFrame]:
    """The facts of the leader's store and of a follower's."""
    return _stored(spark, d), store.read(spark, _follower(spark, d, name))


def _tails(spark: SparkSession, d: str) -> DataFrame:
    """(lsn, root) of the tails of three stores, from their anchors."""
    tails = None
    for path in (_store(spark, d), _follower(spark, d, "whole"), _follower(spark, d, "behind")):
        one = store.anchors(spark, path).agg(F.max("last_lsn").alias("lsn"), F.max_by("root", "last_lsn").alias("root"))
        tails = one if tails is None else tails.union(one)
    return tails


def _cases(spark: SparkSession, d: str) -> DataFrame:
    """The built-in connector's regression cases, and all parsed lines as cases that expect log.info."""
    lines = _facts(spark, d).select(F.col("raw").alias("input"), F.lit("log.info").alias("expect_action"))
    own = spark.createDataFrame(list(DATABASE.cases), lines.schema)
    return ingest.coverage(own.union(lines), DATABASE).select(F.lit(DATABASE.name).alias("name"), "cases", "matching")


def _from_text(spark: SparkSession, d: str) -> DataFrame:
    """Facts of the lines written as text files, with blank lines between them."""
    path = f"{shared_folder(spark, 'text')}/lines"
    blank = F.when(F.col("seq") % 3 == 0, F.array("raw", F.lit(" \t"))).otherwise(F.array("raw"))
    _lines(spark, d).select(F.explode(blank)).write.text(path)
    return ingest.facts(text_lines(spark, path), DATABASE).select("raw", "rule_id", "action", "actor")


def _from_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """What a stream put aside, read again as lines."""
    return text_lines(spark, f"{_streamed_store(spark, d)}/quarantine/*").select("raw")


def _from_artifact(spark: SparkSession, d: str) -> DataFrame:
    """Facts under the database connector as its folder of components gives it."""
    path = shared_folder(spark, "artifact")
    artifact.save(spark, DATABASE, path)
    return ingest.facts(_obs(spark, d), artifact.load(spark, path)).select(*FACT, "confidence", "steps").withColumn("steps", F.array_join("steps", ","))


def _from_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of a test matrix: all parsed lines with the action that their event's type stands for, in one file a task."""
    path = f"{shared_folder(spark, 'matrix')}/cases"
    e = spread(spark.read.parquet(f"{d}/events.parquet"))
    action = F.when(F.col("event_type") == "error", "authentication.failure").when(F.col("event_type") == "signup", "authentication.success").otherwise("query.execute")
    cases = e.select(F.spark_partition_id().alias("part"), F.struct(event_line().alias("input"), action.alias("expect_action")).alias("c"))
    # files of a bounded number of cases each
    cases.withColumn("k", F.floor(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) / 5000)).groupBy("part", "k").agg(F.collect_list("c").alias("cases")).select("cases").write.option("lineSep", "\n\n").option("maxRecordsPerFile", 1).json(path)
    return ingest.coverage(matrix_cases(spark, path), DATABASE).select("cases", "matching")


def _one_by_one(spark: SparkSession, d: str) -> DataFrame:
    """Anchors of a store to which three facts were appended singly before all others."""
    path = shared_folder(spark, "singles")
    facts = scratch(_facts(spark, d), "singles")
    first = [r[0] for r in facts.orderBy("seq").select("seq").limit(3).collect()]
    for seq in first:
        store.append(facts.filter(F.col("seq") == seq), path, block_facts=BLOCK)
    store.append(facts.filter(~F.col("seq").isin(*first)), path, block_facts=BLOCK)
    return store.anchors(spark, path).select("block", "first_lsn", "last_lsn", "facts", "root")


def _days(spark: SparkSession, d: str) -> DataFrame:
    return views.daily(_facts(spark, d))


def _by_rule(*when: Condition, actor: str = "${user}") -> Callable[[SparkSession, str], DataFrame]:
    """Facts under a connector of one rule."""
    rule = Connector("probe", 1.0, DATABASE.pattern, (Rule("hit", when, actor=actor),), ())
    return lambda s, d: ingest.facts(_obs(s, d), rule)


#: A pattern with a group that may match empty and one that may take no part or match empty.
NUMBERED = Connector(
    "numbered", 1.0, r"\[(?P<pid>\d+)\] (?P<rest>.*?)(?P<num>\d*)(?:!(?P<user>\w*))?$",
    (Rule("ends_plain", (Condition("num", equals=""),), actor="${pid}"), Rule("ends_in_seven", (Condition("num", matches="7$"),), actor="n${num}"), Rule("no_user", (Condition("user", equals=""),))), (),
)


def _in_batches(rows: DataFrame, batch: str, batches: int, path: str) -> DataFrame:
    """A stream of rows in order of their column batch, 0 to batches - 1, from files as old as their batches.

    Rows are kept by batch, so that each is read and written by its own turn only; a file is split among tasks by its
    small row groups.
    """
    kept = shared_folder(rows.sparkSession, "by-batch")
    rows.write.partitionBy(batch).mode("overwrite").parquet(kept)
    schema = rows.drop(batch).schema
    for k in range(batches):
        at = f"{kept}/{batch}={k}"
        some = rows.sparkSession.read.schema(schema).parquet(at) if exists(rows.sparkSession, at) else rows.sparkSession.createDataFrame([], schema)
        some.coalesce(1).write.option("parquet.block.size", ROW_GROUP).mode("append").parquet(path)
    return rows.sparkSession.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


#: Bytes of a row group of files that a stream reads one by one.
ROW_GROUP = 8 << 20


def _in_turn(rows: DataFrame, path: str, batches: int) -> DataFrame:
    """A stream of rows in order of seq, in so many batches of about equal spans."""
    low, high = rows.agg(F.min("seq"), F.max("seq")).first()
    width = (high - low) // batches + 1 if low is not None else 1
    return _in_batches(rows.withColumn("due", F.floor((F.col("seq") - (low or 0)) / width)), "due", batches, path)


def _streamed(lateness: str | None) -> Callable[[SparkSession, str], DataFrame]:
    """The week's window as a stream in five batches, with state from one to the next."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        base = shared_folder(spark, "stream")
        some = _facts(spark, d).select("seq", "action", "actor", "system_timestamp")
        made = behavior_stream(_in_turn(some, f"{base}/in", 5), WEEK, lateness)
        made.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{base}/out")

    return run


def _streamed_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of all lines, grown over a stream of three batches."""
    base = shared_folder(spark, "clusters")
    lines = _in_turn(_lines(spark, d), f"{base}/in", 3)
    lines.writeStream.foreachBatch(clusters_to(f"{base}/out")).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return evolve.absorbed(spark, f"{base}/out")


def _delayed(spark: SparkSession, d: str) -> str:
    """A stream of eight batches of four days each, in which some facts come one batch or three too late.

    Kept by kind in the shared folder; run once in an application for each input.
    """
    key = (spark.sparkContext.applicationId, f"delayed {d}")
    if key not in _stores:
        base = shared_folder(spark, "timed")
        day = F.floor((F.col("system_timestamp") - 1_704_067_200_000_000) / 86_400_000_000)
        due = F.floor(day / 4) + F.when(F.col("seq") % 11 == 3, 1).when(F.col("seq") % 29 == 4, 3).otherwise(0)
        some = _facts(spark, d).select("seq", "action", "actor", "system_timestamp", F.least(due, F.lit(7)).cast("int").alias("due"))
        lines = _in_batches(some, "due", 8, f"{base}/in")
        with timed.timers(spark):
            made = timed.windows(lines, WEEK, "1 day").writeStream.foreachBatch(timed.kinds_to(f"{base}/out"))
            query = made.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        _stores[key] = f"{base}/out"
    return _stores[key]


def _streamed_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions that a stream of facts in order of time has closed, in four batches."""
    base = shared_folder(spark, "sessions")
    facts = scratch(_facts(spark, d).select("seq", "actor", "obs_ts", "action", "risk"), "sessions")
    for k in range(4):
        facts.filter(F.floor((F.dayofmonth("obs_ts") - 1) / 8) == k).coalesce(1).write.mode("append").parquet(f"{base}/in")
    lines = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in").withWatermark("obs_ts", "1 hour")
    made = behavior.sessions(lines, "2 hours").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
    made.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _streamed_store(spark: SparkSession, d: str) -> str:
    """A store filled by a stream of observations over files, one file a batch."""
    base = shared_folder(spark, "ingest")
    lines = _in_turn(_obs(spark, d), f"{base}/in", 3)
    lines.writeStream.foreachBatch(ingest_to(f"{base}/store", DATABASE)).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return f"{base}/store"


_SOME_ALIASES = "fact.id, actor.id, actor.name, target.id, source.ip, fact.behavior.class, fact.behavior.action, fact.behavior.risk_level, fact.knowledge_version, lsn, timestamp"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "behavior_escalation": lambda s, d: behavior.escalate(_facts(s, d).select(*FACT), (WEEK,)).filter("window_count >= 5").select(*FACT, "window_count"),
    "behavior_window_count": lambda s, d: behavior.escalate(_facts(s, d).select(*FACT), (WEEK,)).filter("window_count > 0").select("seq", "actor", "window_count"),
    "behavior_multi_signature": lambda s, d: behavior.escalate(_facts(s, d).select(*FACT), (WEEK, DAY)).select("seq", "class", "risk"),
    "behavior_null_actor_bucket": lambda s, d: behavior.escalate(_facts(s, d).select(*FACT).withColumn("actor", F.lit(None).cast("string")), (WEEK,)).filter("window_count > 0").select("seq", "window_count"),
    "parse_regex_tokens": _tokens,
    "parse_keyvalue_tokens": _key_values,
    "quarantine_split": lambda s, d: _drift(s, d),
    "syslog_strip": lambda s, d: _obs(s, d).select("seq", ingest.strip_priority(F.concat(F.lit("<13>"), F.col("raw"))).alias("raw")),
    "classify_rules": lambda s, d: _facts(s, d).select(*FACT),
    "rule_hit_counts": lambda s, d: _facts(s, d).groupBy("rule_id").agg(F.count("*").alias("hits")),
    "template_render_identity": lambda s, d: _facts(s, d).select("seq", "actor", "target", "source_ip"),
    "evidence_hash": lambda s, d: _facts(s, d).select("seq", "raw_hash"),
    "evidence_blake3": lambda s, d: ingest.facts(_obs(s, d), DATABASE, "b3").select("seq", "raw_hash"),
    "lsn_assign": lambda s, d: _numbered(s, d).select("seq", "lsn"),
    "leaf_hash": lambda s, d: (lambda n: n.select("lsn", ledger.leaf_hash(n, ("lsn", "system_timestamp", "action", "actor", "target")).alias("leaf")))(_numbered(s, d)),
    "chain_root": lambda s, d: _sealed(s, d).select("lsn", "leaf", "root"),
    "segment_chain_root": lambda s, d: ledger.seal_segments(_numbered(s, d).withColumn("day", F.to_date("obs_ts")), "day", BLOCK),
    "verify_ok": _check(lambda x: x),
    "verify_tampered": _check(lambda x: ledger.tamper(x, TAMPERED)),
    "verify_first_bad_lsn": lambda s, d: ledger.bad_facts(_stored(s, d).filter(F.col("lsn") != TAMPERED), BLOCK),
    "search_action_target": _ask("lsn, actor.name, timestamp", "authentication.failure", "postgresql"),
    "search_wildcard": _ask("lsn, fact.behavior.action"),
    "search_within_days": _ask("lsn, target.id", "query.execute", "prod", (3, "days")),
    "search_within_hours": _ask("lsn", target="prod", within=(12, "hours")),
    "search_within_minutes": _ask("lsn", within=(90, "minutes")),
    "search_unknown_field": _ask("lsn, no.such", "log.info"),
    "template_mask": lambda s, d: _lines(s, d).select("seq", evolve.mask(F.col("raw")).alias("template")),
    "template_groups": lambda s, d: evolve.template_groups(_lines(s, d)),
    "template_jaccard_pairs": lambda s, d: evolve.similar_templates(evolve.template_groups(_lines(s, d)), 0.3, digits=6).select("a", "b", "similarity"),
    "template_set_pairs": lambda s, d: evolve.similar_token_sets(evolve.template_groups(_lines(s, d)), 0.3)[0].select("a", "b", F.round("similarity", 6).alias("similarity")),
    "template_set_members": lambda s, d: evolve.similar_token_sets(evolve.template_groups(_lines(s, d)), 0.3)[1],
    "cluster_entropy": lambda s, d: evolve.entropy(evolve.template_groups(_lines(s, d))),
    "cluster_leader_merge": lambda s, d: evolve.leaders(evolve.template_groups(_lines(s, d))),
    "regex_seed": lambda s, d: evolve.cluster_report(_drift(s, d)),
    "coverage_rate": lambda s, d: ingest.coverage(_obs(s, d).select(F.col("raw").alias("input"), F.lit("authentication.failure").alias("expect_action")), DATABASE).select("cases", "matching"),
    "recent_facts": lambda s, d: views.recent(_stored(s, d), 50).select("lsn", "action"),
    "store_stats": lambda s, d: views.stats(_stored(s, d)),
    "daily_density": lambda s, d: _days(s, d).select("day", "volume", views.density(F.col("volume"), (100, 320, 340)).alias("level")),
    "daily_density_asof": lambda s, d: _days(s, d).select("day", views.density(F.col("volume"), (100, 320, 340), F.col("day") > F.to_date(F.lit("2024-01-15"))).alias("level")),
    "search_versions": _ask("lsn, fact.reasoning_version, fact.ontology_version, fact.knowledge_version", "log.info"),
    "connector_cases": lambda s, d: _cases(s, d),
    "daily_cumulative_lsn": _days,
    "volume_split": lambda s, d: _days(s, d).select("day", *views.split_volume(F.col("volume"))),
    "asof_day": lambda s, d: views.as_of(_days(s, d), "2024-01-15"),
    "asof_lsn_graph": lambda s, d: views.graph_as_of(_stored(s, d).groupBy("actor").agg(F.min("lsn").alias("lsn_start")).filter("actor is not null"), ledger.BASE_LSN + 400, 100),
    "format_suffix": lambda s, d: _facts(s, d).select("seq", views.short_number(F.col("seq") * 1234).alias("text")),
    "replica_missing_range": lambda s, d: views.missing_range(*_replicas(s, d)).select("lsn"),
    "replica_divergence": lambda s, d: views.divergence(*_replicas(s, d, "apart")),
    "commit_lsn": lambda s, d: views.commit_lsn(_tails(s, d)),
    "replica_convergence": lambda s, d: views.converged(_tails(s, d)),
    "cond_equals": lambda s, d: _by_rule(Condition("db", equals="prod"))(s, d).select("seq", "rule_id"),
    "cond_contains": lambda s, d: _by_rule(Condition("message", contains="denied"))(s, d).select("seq", "rule_id"),
    "cond_in": lambda s, d: _by_rule(Condition("user", among=("u1", "u2", "u3")))(s, d).select("seq", "rule_id"),
    "cond_severity_in": lambda s, d: _by_rule(Condition(severity_in=("FATAL", "ERROR")))(s, d).select("seq", "rule_id"),
    "cond_matches_capture": lambda s, d: _by_rule(Condition("message", matches=r"table t(?P<user>\d+)"))(s, d).select("seq", "actor"),
    "rule_default_fallback": lambda s, d: _by_rule(Condition("db", equals="nowhere"))(s, d).select("seq", "rule_id", "action", "class", "risk", "actor"),
    "fact_id": lambda s, d: _facts(s, d).select("seq", "fact_id"),
    "search_aliases": _ask(_SOME_ALIASES, target="prod"),
    "signature_checksum": lambda s, d: _stored(s, d).select("lsn", "checksum"),
    "block_chain_root": lambda s, d: ledger.block_roots(_sealed(s, d)).select("block", "last_lsn", "root"),
    "template_tokens": lambda s, d: evolve.template_groups(_lines(s, d)).select("template", F.array_join(F.array_sort(evolve.tokens(F.col("template"))), " ").alias("tokens")),
    "stream_behavior_equals_batch": _streamed(None),
    "stream_behavior_evicting": _streamed("1 day"),
    "stream_drift_metrics": lambda s, d: s.read.parquet(f"{_streamed_store(s, d)}/counters").groupBy().agg(F.sum("sealed").alias("sealed"), F.sum("quarantined").alias("quarantined")),
    "stream_store_verified": lambda s, d: store.verify(s, _streamed_store(s, d)).select("status", "facts"),
    "verify_blocks": lambda s, d: store.verify(s, _store(s, d), BLOCK).select("status", "facts"),
    "verify_doubled": _check(lambda x: x.union(x.filter(F.col("lsn") == TAMPERED))),
    "verify_lost_tail": _check(lambda x: x.filter(F.col("lsn") < TAMPERED)),
    "threat_tags": lambda s, d: _reports(threats.tagged(_ssh(s, d), _providers(s, d))),
    "threat_tag_counts": lambda s, d: threats.tag_counts(threats.tagged(_ssh(s, d), _providers(s, d))),
    "knowledge_diff": lambda s, d: versions.difference(versions.compared(_obs(s, d), DATABASE, NEXT)).drop("sample").withColumn("risk_step", F.col("risk_step").cast("string")),
    "knowledge_changes": lambda s, d: versions.compared(_stored(s, d).select("seq", "raw"), DATABASE, NEXT).groupBy("change").agg(F.count("*").alias("lines")),
    "ontology_closure": lambda s, d: ontology.closure(_ways(s, d)),
    "ontology_rollup": lambda s, d: ontology.rolled_up(s.read.parquet(f"{d}/events.parquet"), _ways(s, d), "user_id"),
    "rules_shared": lambda s, d: shared_rules.classify(ingest.parse(_obs(s, d), MANY), MANY).select("seq", "semantic.rule_id", "semantic.action", "semantic.actor"),
    "source_text_file": _from_text,
    "source_quarantine_file": _from_quarantine,
    "source_artifact": _from_artifact,
    "source_test_matrix": _from_matrix,
    "store_append_one": _one_by_one,
    "store_order": lambda s, d: store.read(s, _store(s, d), ordered=True).select("lsn", "seq", "action"),
    "stream_sessions": _streamed_sessions,
    "stream_drift_clusters": _streamed_clusters,
    "stream_timed_counts": lambda s, d: timed.of_kind(s, _delayed(s, d), timed.COUNTED).select("batch", "seq", "actor", "system_timestamp", "window_count", "fired"),
    "stream_timed_late": lambda s, d: timed.of_kind(s, _delayed(s, d), timed.LATE).select("batch", "seq", "actor", "system_timestamp"),
    "stream_timed_late_counts": lambda s, d: timed.late_counts(s, _delayed(s, d)),
    "stream_timed_evicted": lambda s, d: timed.of_kind(s, _delayed(s, d), timed.EVICTED).select("batch", "actor", "system_timestamp"),
    "route_facts": lambda s, d: route.facts(_dealt(s, d), REGISTRY).select(*FACT, "source", "source_ip", "knowledge_version", "confidence"),
    "route_unrouted": lambda s, d: route.unrouted(_dealt(s, d)).select("seq", "source", "raw", "reason"),
    "route_counters": lambda s, d: route.counters(_dealt(s, d)),
    "route_escalation": lambda s, d: route.escalate(route.facts(_dealt(s, d), REGISTRY).select(*FACT, "knowledge_version"), REGISTRY, WATCH).filter("window_count > 0").select("seq", "knowledge_version", "class", "risk", "window_count"),
    "cond_matches_optional": lambda s, d: _by_rule(Condition("message", matches=r"table t(?:(?P<user>\d\d))?"))(s, d).select("seq", "rule_id", "actor"),
    "cond_equals_empty": lambda s, d: ingest.facts(_obs(s, d), NUMBERED).select("seq", "rule_id", "actor"),
    "behavior_hot_actor": lambda s, d: behavior.escalate(_facts(s, d).withColumn("actor", F.when(F.col("actor") < "u5", F.col("actor"))), (WEEK,), hot_facts=100).filter("window_count > 0").select("seq", "window_count", "class"),
    "sessions": lambda s, d: behavior.sessions(_facts(s, d), "2 hours"),
    "verify_forged_block": _reforged,
    "verify_forged_anchor": _reanchored,
    "verify_lost_head": _check(lambda x: x.filter(F.col("block") > 0)),
    "store_append": lambda s, d: store.anchors(s, _append(s, d)).select("block", "first_lsn", "last_lsn", "facts", "root"),
    "anchor": lambda s, d: store.anchors(s, _store(s, d)).select("block", "anchor"),
    "append_accepted": lambda s, d: views.accepts(_replicas(s, d)[1], ledger.BASE_LSN + 900, (_stored(s, d).filter(F.col("lsn") == ledger.BASE_LSN + 900).select("root").first() or ("",))[0]),
    "replica_catch_up": _caught_up,
    "nested_facts": lambda s, d: nested(_stored(s, d)).select("fact_id", "identity.actor_id", "behavior.risk_level", "time.log_sequence_number", "lineage.matched_rule", F.col("integrity.leaf_hash").isNotNull().alias("sealed")),
    "search_integrity": _ask("lsn, fact.confidence, integrity.merkle_root_anchor, integrity.signature", target="prod"),
    "ssh_rules": lambda s, d: _ssh(s, d).select("seq", "action", "class", "risk", "actor", "target", "source_ip"),
    "keyvalue_rules": lambda s, d: _kv(s, d).select("seq", "rule_id", "action", "class", "risk", "actor", "target"),
    "step_order": lambda s, d: _stored(s, d).select(F.posexplode("steps").alias("place", "step")).distinct(),
    "daily_trailing": lambda s, d: views.trailing(_days(s, d)).select("day", "trailing"),
    "asof_lsn_edges": lambda s, d: views.edges_as_of(_stored(s, d), ledger.BASE_LSN + 400),
}

_OBS = """obs AS (SELECT event_id AS seq, ts, user_id, event_type AS kind, epoch_us(ts) AS us,
  CASE WHEN event_id % 50 = 7 THEN 'GARBAGE ' || event_id || ' k=' || (props ->> '$.k')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' UTC [' || event_id || '] ' || CASE event_type
    WHEN 'error' THEN 'FATAL:  password authentication failed for user "u' || user_id || '"'
    WHEN 'signup' THEN 'u' || user_id || '@prod LOG:  connection authorized: user=u' || user_id || ' database=prod'
    WHEN 'purchase' THEN 'u' || user_id || '@prod LOG:  statement: SELECT ' || (props ->> '$.k')
    WHEN 'click' THEN 'u' || user_id || '@prod ERROR:  permission denied for table t' || (props ->> '$.k')
    ELSE 'LOG:  checkpoint ' || (props ->> '$.k') END END AS raw FROM events)"""
_FACTS = (
    _OBS
    + r""", p AS (SELECT *, regexp_extract(raw, '^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?(?: \S+)?) \[(\d+)\] (?:(\w+)@(\w+) )?([A-Z]+):\s+(.*)$', ['ts', 'pid', 'user', 'db', 'severity', 'message']) AS t FROM obs
  WHERE regexp_matches(raw, '^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?(?: \S+)?) \[(\d+)\] (?:(\w+)@(\w+) )?([A-Z]+):\s+(.*)$')),
r AS (SELECT *, CASE WHEN regexp_matches(t.message, 'password authentication failed for user "[^"]+"') THEN 1
  WHEN regexp_matches(t.message, 'connection authorized: user=\w+') THEN 2 WHEN contains(t.message, 'permission denied') THEN 3
  WHEN regexp_matches(t.message, '^statement: .+$') THEN 4 WHEN t.severity IN ('FATAL', 'PANIC') THEN 5 ELSE 6 END AS k FROM p),
facts AS (SELECT seq, ts, us AS system_timestamp, raw,
  ['pg_auth_failure', 'pg_connection_authorized', 'pg_permission_denied', 'pg_statement', 'pg_fatal', 'pg_info'][k] AS rule_id,
  ['authentication.failure', 'authentication.success', 'authorization.failure', 'query.execute', 'system.fault', 'log.info'][k] AS action,
  ['credential_attack', 'session', 'privilege_violation', 'data_access', 'availability', 'observation'][k] AS class,
  ['High', 'Low', 'Medium', 'Low', 'High', 'Low'][k] AS risk,
  nullif(CASE k WHEN 1 THEN regexp_extract(t.message, 'user "([^"]+)"', 1) WHEN 2 THEN regexp_extract(t.message, 'user=(\w+)', 1) ELSE t.user END, '') AS actor,
  nullif(CASE k WHEN 1 THEN 'postgresql' WHEN 2 THEN regexp_extract(t.message, ' database=(\w+)', 1) ELSE t.db END, '') AS target,
  14812337 + row_number() OVER (ORDER BY seq) AS lsn FROM r),
w AS (SELECT seq, count(*) OVER (PARTITION BY actor ORDER BY system_timestamp RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW) AS n7,
  count(*) OVER (PARTITION BY actor ORDER BY system_timestamp RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS n1,
  count(*) OVER (ORDER BY system_timestamp RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW) AS n0 FROM facts WHERE action = 'authentication.failure')"""
)
_MASKED = (
    _OBS
    + r""", m AS (SELECT seq, raw, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw,
  '\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:\s(?:UTC|GMT|Z))?', '<TS>', 'g'), '\b\d{1,3}(?:\.\d{1,3}){3}\b', '<IP>', 'g'), '\b[0-9a-fA-F]{12,}\b', '<HEX>', 'g'),
  '"[^"]*"', '<STR>', 'g'), '\b\d+\b', '<NUM>', 'g'), '=[A-Za-z0-9_./@:-]+', '=<VAL>', 'g'), '\s+', ' ', 'g')) AS template FROM obs),
g AS (SELECT template, count(*) AS count, min(seq) AS first_seq, arg_min(raw, seq) AS sample FROM m GROUP BY template)"""
)
_DAYS = _FACTS + ", d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS volume FROM facts GROUP BY 1)"


def _f(rest: str) -> str:
    return f"WITH {_FACTS} {rest}"


_FIELDS = "seq, rule_id, action, class, risk, actor, target, system_timestamp"
_LEAF = "sha256(concat_ws(',', {}))".format(", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("lsn", "system_timestamp", "action", "actor", "target")))
_FACT_ID = "substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-7' || substr(h, 1, 3) || '-8' || substr(h, 4, 3) || '-' || substr(h, 7, 12)"
_IDS = f"i AS (SELECT seq, {_FACT_ID} AS fact_id FROM (SELECT seq, printf('%012x', system_timestamp // 1000) AS m, sha256('events:' || seq || ':' || raw) AS h FROM facts))"
_SEALED_FIELDS = (
    "lsn", "seq", "fact_id", "system_timestamp", "'events'", "raw", "rule_id", "action", "class", "risk", "actor", "target", "CAST(NULL AS VARCHAR)",
    "system_timestamp", "'0.972'", "('s256:' || sha256(raw))", "'parse;normalize;behavior;emit'", "'postgresql'", "'icp_brasil_serpro_tst_recibo'", "'reasoner-core-v6.0'", "'v9'",
)
_SEALED_LEAF = "sha256(concat_ws(',', {}))".format(", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in _SEALED_FIELDS))
_LEAVES = f"{_IDS}, l AS MATERIALIZED (SELECT lsn, (lsn - 14812338) // 500 AS block, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, action, target, {_SEALED_LEAF} AS leaf FROM facts JOIN i USING (seq))"
_CHAIN = "list_reduce(list(leaf ORDER BY lsn), lambda a, b: sha256(a || b), '')"
_BLOCKS = f"b AS (SELECT block, min(lsn) AS first_lsn, max(lsn) AS last_lsn, count(*) AS facts, {_CHAIN} AS root FROM l GROUP BY block)"
_ROOTS = "c(lsn, leaf, root) AS (SELECT lsn, leaf, sha256(leaf) FROM l WHERE (lsn - 14812338) % 500 = 0 UNION ALL SELECT l.lsn, l.leaf, sha256(c.root || l.leaf) FROM c JOIN l ON l.lsn = c.lsn + 1 WHERE (l.lsn - 14812338) % 500 <> 0)"
_ROUTED = (
    _FACTS
    + """, mixed AS (SELECT event_id AS seq, ts, user_id, event_id % 7 AS k, event_type, epoch_us(ts) AS system_timestamp, CASE WHEN event_id % 7 IN (0, 1) THEN 'db' WHEN event_id % 7 = 2 THEN 'edge' WHEN event_id % 7 = 3 THEN 'app' ELSE 'unknown' END AS source,
  CASE WHEN event_id % 7 IN (0, 1, 4) THEN o.raw WHEN event_id % 7 IN (2, 5) THEN '<13> u' || e.user_id || ' failed password for db' || e.user_id || ' from 10.0.0.' || e.user_id % 200
    ELSE 'USER=u' || e.user_id || CASE WHEN event_type = 'error' THEN ' ACTION=drop_table STATUS=failed TARGET=t' ELSE ' ACTION=read STATUS=ok TARGET=t' END || event_id % 9 END AS raw
  FROM events e JOIN (SELECT seq, raw FROM obs) o ON o.seq = e.event_id),
routed AS (SELECT f.seq, rule_id, action, class, risk, actor, target, f.system_timestamp, source, CAST(NULL AS VARCHAR) AS source_ip, 'postgresql' AS knowledge_version, CAST(0.972 AS DOUBLE) AS confidence FROM facts f JOIN mixed USING (seq) WHERE k IN (0, 1, 4)
  UNION ALL SELECT seq, 'ssh_auth_failure', 'authentication.failure', 'credential_attack', 'High', 'u' || user_id, 'db' || user_id, system_timestamp, source, '10.0.0.' || user_id % 200, 'linux_sshd', CAST(0.984 AS DOUBLE) FROM mixed WHERE k IN (2, 5)
  UNION ALL SELECT seq, CASE WHEN event_type = 'error' THEN 'kv_destructive_failure' ELSE 'kv_default' END, CASE WHEN event_type = 'error' THEN 'data.deletion.failure' ELSE 'log.info' END, CASE WHEN event_type = 'error' THEN 'data_tampering' ELSE 'observation' END,
    CASE WHEN event_type = 'error' THEN 'High' ELSE 'Low' END, 'u' || user_id, 't' || seq % 9, system_timestamp, source, NULL, 'keyvalue_generic', CAST(0.91 AS DOUBLE) FROM mixed WHERE k = 3)"""
)
_HIT = "SELECT seq, CASE WHEN {} THEN 'hit' ELSE '__unmatched__' END AS rule_id FROM p"
ORACLE_SQL: dict[str, str] = {
    "cond_equals": _f(_HIT.format("t.db = 'prod'")),
    "cond_contains": _f(_HIT.format("contains(t.message, 'denied')")),
    "cond_in": _f(_HIT.format("t.user IN ('u1', 'u2', 'u3')")),
    "cond_severity_in": _f(_HIT.format("t.severity IN ('FATAL', 'ERROR')")),
    "cond_matches_capture": _f("SELECT seq, nullif(regexp_extract(t.message, 'table t(\\d+)', 1), '') AS actor FROM p"),
    "rule_default_fallback": _f("SELECT seq, '__unmatched__' AS rule_id, 'log.unknown' AS action, 'observation' AS class, 'Low' AS risk, CAST(NULL AS VARCHAR) AS actor FROM p"),
    "fact_id": _f(f", {_IDS} SELECT seq, fact_id FROM i"),
    "search_aliases": _f(f""", {_IDS} SELECT fact_id AS "fact.id", actor AS "actor.id", actor AS "actor.name", target AS "target.id", CAST(NULL AS VARCHAR) AS "source.ip", class AS "fact.behavior.class",
  action AS "fact.behavior.action", risk AS "fact.behavior.risk_level", 'postgresql' AS "fact.knowledge_version", lsn, system_timestamp AS timestamp FROM facts JOIN i USING (seq) WHERE target = 'prod'"""),
    "signature_checksum": _f(f", {_LEAVES} SELECT lsn, substr(sha256('factloom:' || leaf), 1, 48) AS checksum FROM l"),
    "block_chain_root": _f(f", {_LEAVES}, {_BLOCKS} SELECT block, last_lsn, root FROM b"),
    "segment_chain_root": _f(f", {_LEAVES}, e AS (SELECT day, block, min(lsn) AS lsn, max(lsn) AS last_lsn, count(*) AS facts, {_CHAIN} AS leaf FROM l GROUP BY day, block), d AS (SELECT day AS segment, min(lsn) AS first_lsn, max(last_lsn) AS last_lsn, CAST(sum(facts) AS BIGINT) AS facts, {_CHAIN} AS root FROM e GROUP BY day) SELECT *, list_reduce(list(root) OVER (ORDER BY segment), lambda a, b: sha256(a || b), '') AS anchor FROM d"),
    "verify_first_bad_lsn": _f("SELECT lsn, 'gap' AS reason FROM facts WHERE lsn = 14812337 + 701"),
    "chain_root": f"WITH RECURSIVE {_FACTS}, {_LEAVES}, {_ROOTS} SELECT lsn, leaf, root FROM c",
    "search_integrity": f"WITH RECURSIVE {_FACTS}, {_LEAVES}, {_ROOTS} SELECT lsn, CAST(0.972 AS DOUBLE) AS \"fact.confidence\", root AS \"integrity.merkle_root_anchor\", substr(sha256('factloom:' || c.leaf), 1, 48) AS \"integrity.signature\" FROM c JOIN l USING (lsn) WHERE target = 'prod'",
    "store_append": _f(f", {_LEAVES}, {_BLOCKS} SELECT block, first_lsn, last_lsn, facts, root FROM b"),
    "anchor": _f(f", {_LEAVES}, {_BLOCKS} SELECT block, list_reduce(list(root) OVER (ORDER BY block), lambda a, b: sha256(a || b), '') AS anchor FROM b"),
    "verify_blocks": _f("SELECT 'INTEG_OK' AS status, count(*) AS facts FROM facts"),
    "verify_doubled": _f("SELECT CASE WHEN count(*) >= 700 THEN 'VIOLATED' ELSE 'INTEG_OK' END AS status, CASE WHEN count(*) >= 700 THEN CAST(699 AS BIGINT) ELSE count(*) END AS facts FROM facts"),
    "verify_lost_tail": _f("SELECT CASE WHEN count(*) >= 700 THEN 'VIOLATED' ELSE 'INTEG_OK' END AS status, CASE WHEN count(*) >= 700 THEN CAST(699 AS BIGINT) ELSE count(*) END AS facts FROM facts"),
    "source_text_file": _f("SELECT raw, rule_id, action, actor FROM facts"),
    "source_quarantine_file": f"WITH {_OBS} SELECT raw FROM obs WHERE seq % 50 = 7",
    "source_artifact": _f("SELECT seq, rule_id, action, class, risk, actor, target, system_timestamp, CAST(0.972 AS DOUBLE) AS confidence, 'parse,normalize,behavior,emit' AS steps FROM facts"),
    "source_test_matrix": _f("SELECT (SELECT count(*) FROM obs) AS cases, count(*) FILTER (action = CASE kind WHEN 'error' THEN 'authentication.failure' WHEN 'signup' THEN 'authentication.success' ELSE 'query.execute' END) AS matching FROM facts JOIN (SELECT seq, kind FROM obs) USING (seq)"),
    "store_order": _f("SELECT lsn, seq, action FROM facts"),
    "store_append_one": f"WITH RECURSIVE {_FACTS}, {_LEAVES}, {_ROOTS}, e AS (SELECT lsn, (lsn - 14812338) // 500 AS block, CASE WHEN lsn <= 14812340 THEN lsn ELSE 14812341 + (lsn - 14812338) // 500 END AS part, root FROM c) SELECT block, min(lsn) AS first_lsn, max(lsn) AS last_lsn, count(*) AS facts, arg_max(root, lsn) AS root FROM e GROUP BY block, part",
    "threat_tags": "WITH {} SELECT seq, source_ip, tags FROM tagged",
    "threat_tag_counts": "WITH {} SELECT string_split(t, '/')[1] AS provider, string_split(t, '/')[2] AS tag, string_split(t, '/')[3] AS kind, count(*) AS facts FROM (SELECT unnest(string_split(tags, ',')) AS t FROM tagged) GROUP BY ALL",
    "knowledge_changes": r"WITH {} SELECT change, count(*) AS lines FROM bo WHERE old_rule IS NOT NULL GROUP BY change",
    "ontology_closure": "WITH RECURSIVE w AS (SELECT i AS class, i AS ancestor, 0 AS distance FROM (SELECT unnest(range(1, max(user_id) + 1)) AS i FROM events) UNION ALL SELECT class, ancestor // 2, distance + 1 FROM w WHERE ancestor > 1) SELECT CAST(class AS VARCHAR) AS class, CAST(ancestor AS VARCHAR) AS ancestor, CAST(distance AS BIGINT) AS distance FROM w",
    "ontology_rollup": """WITH RECURSIVE w AS (SELECT i AS class, i AS ancestor, 0 AS distance FROM (SELECT unnest(range(1, max(user_id) + 1)) AS i FROM events) UNION ALL SELECT class, ancestor // 2, distance + 1 FROM w WHERE ancestor > 1),
  c AS (SELECT user_id AS class, count(*) AS own FROM events GROUP BY 1),
  e AS (SELECT * FROM w UNION ALL SELECT class, class, 0 FROM c WHERE class NOT IN (SELECT class FROM w))
  SELECT CAST(e.ancestor AS VARCHAR) AS class, (SELECT CAST(max(distance) AS BIGINT) FROM e x WHERE x.class = e.ancestor) AS level, CAST(sum(CASE WHEN distance = 0 THEN coalesce(own, 0) ELSE 0 END) AS BIGINT) AS own, CAST(sum(coalesce(own, 0)) AS BIGINT) AS total
  FROM e LEFT JOIN c USING (class) GROUP BY e.ancestor""",
    "rules_shared": _f("""SELECT p.seq, coalesce('r' || m.i, '__unmatched__') AS rule_id, coalesce('seen.' || m.i % 7, 'log.unknown') AS action, CASE WHEN m.i IS NOT NULL THEN nullif(t.user, '') END AS actor
  FROM p LEFT JOIN (SELECT seq, max(i) AS i FROM p, (SELECT unnest(range(500)) AS i) WHERE contains(t.message, CAST(i % 250 AS VARCHAR)) AND CASE WHEN i < 250 THEN t.severity IN ('ERROR', 'FATAL') ELSE t.severity = 'LOG' END GROUP BY seq) m USING (seq)"""),
    "stream_sessions": _f("""SELECT * FROM (SELECT actor, make_timestamp(min(system_timestamp)) AS opened, make_timestamp(max(system_timestamp) + 7200000000) AS closed, count(*) AS facts, array_to_string(list_sort(list_distinct(list(action))), ',') AS actions,
  ['Low', 'Medium', 'High', 'Critical'][max(list_position(['Low', 'Medium', 'High', 'Critical'], risk))] AS worst
  FROM (SELECT *, sum(opens) OVER (PARTITION BY actor ORDER BY system_timestamp, seq) AS session FROM (SELECT coalesce(actor, 'unknown') AS actor, system_timestamp, seq, action, risk, CASE WHEN system_timestamp - lag(system_timestamp) OVER (PARTITION BY coalesce(actor, 'unknown') ORDER BY system_timestamp, seq) <= 7200000000 THEN 0 ELSE 1 END AS opens FROM facts)) GROUP BY actor, session)
  WHERE epoch_us(closed) // 1000 <= (SELECT max(system_timestamp) // 1000 - 3600000 FROM facts)"""),
    "stream_timed_counts": "WITH {} SELECT *, window_count >= 5 AS fired FROM (SELECT a.batch, a.seq, a.actor, a.system_timestamp, count(*) AS window_count FROM o a JOIN o b ON a.actor = b.actor AND b.system_timestamp BETWEEN a.system_timestamp - 604800000000 AND a.system_timestamp AND (b.batch, b.system_timestamp, b.seq) <= (a.batch, a.system_timestamp, a.seq) GROUP BY ALL)",
    "stream_timed_late": "WITH {} SELECT batch, seq, actor, system_timestamp FROM l WHERE late",
    "stream_timed_late_counts": "WITH {} SELECT batch, count(*) AS late FROM l WHERE late GROUP BY batch",
    "stream_timed_evicted": """WITH {}, v AS (SELECT actor, batch, max(max(system_timestamp)) OVER (PARTITION BY actor ORDER BY batch) AS upto, coalesce(lead(batch) OVER (PARTITION BY actor ORDER BY batch), 9) AS next FROM o GROUP BY actor, batch)
  SELECT min(k.batch) AS batch, actor, upto AS system_timestamp FROM v JOIN k ON k.batch > v.batch AND k.batch < v.next AND k.mark >= (upto + 604800000000) // 1000 + 1 GROUP BY actor, upto, v.batch""",
    "route_facts": "WITH {} SELECT seq, rule_id, action, class, risk, actor, target, system_timestamp, source, source_ip, knowledge_version, confidence FROM routed",
    "route_unrouted": "WITH {} SELECT seq, source, raw, CASE WHEN source = 'unknown' THEN 'no_connector' ELSE 'drift' END AS reason FROM mixed WHERE seq NOT IN (SELECT seq FROM routed)",
    "route_counters": "WITH {} SELECT m.source, r.knowledge_version AS connector, CASE WHEN r.seq IS NULL THEN CASE WHEN m.source = 'unknown' THEN 'no_connector' ELSE 'drift' END END AS reason, count(*) AS lines FROM mixed m LEFT JOIN routed r USING (seq) GROUP BY ALL",
    "route_escalation": """WITH {}, v AS (SELECT *, count(*) OVER (PARTITION BY knowledge_version, action, actor ORDER BY system_timestamp RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW) AS n FROM routed WHERE action = 'authentication.failure' OR action = 'data.deletion.failure')
  SELECT seq, knowledge_version, CASE WHEN n >= least_n THEN CASE action WHEN 'data.deletion.failure' THEN 'sabotage_attempt' ELSE 'brute_force_attack' END ELSE class END AS class, CASE WHEN n >= least_n THEN 'Critical' ELSE risk END AS risk, n AS window_count
  FROM (SELECT *, CASE knowledge_version WHEN 'postgresql' THEN 5 WHEN 'linux_sshd' THEN 4 ELSE 3 END AS least_n FROM v)""",
    "cond_matches_optional": _f(r"SELECT seq, CASE WHEN regexp_matches(t.message, 'table t') THEN 'hit' ELSE '__unmatched__' END AS rule_id, CASE WHEN regexp_matches(t.message, 'table t') THEN coalesce(nullif(regexp_extract(t.message, 'table t(\d\d)', 1), ''), nullif(t.user, '')) END AS actor FROM p"),
    "cond_equals_empty": rf"WITH {_OBS}, q AS (SELECT seq, regexp_extract(raw, '\[(\d+)\] ', 1) AS pid, regexp_extract(raw, '(\d*)$', 1) AS num FROM obs WHERE regexp_matches(raw, '\[\d+\] ')) SELECT seq, CASE WHEN num = '' THEN 'ends_plain' WHEN num LIKE '%7' THEN 'ends_in_seven' ELSE '__unmatched__' END AS rule_id, CASE WHEN num = '' THEN pid WHEN num LIKE '%7' THEN 'n' || num END AS actor FROM q",
    "behavior_hot_actor": _f("SELECT seq, n AS window_count, CASE WHEN n >= 5 THEN 'brute_force_attack' ELSE 'credential_attack' END AS class FROM (SELECT seq, count(*) OVER (PARTITION BY CASE WHEN actor < 'u5' THEN actor END ORDER BY system_timestamp RANGE BETWEEN 604800000000 PRECEDING AND CURRENT ROW) AS n FROM facts WHERE action = 'authentication.failure')"),
    "sessions": _f("""SELECT actor, make_timestamp(min(system_timestamp)) AS opened, make_timestamp(max(system_timestamp) + 7200000000) AS closed, count(*) AS facts, array_to_string(list_sort(list_distinct(list(action))), ',') AS actions,
  ['Low', 'Medium', 'High', 'Critical'][max(list_position(['Low', 'Medium', 'High', 'Critical'], risk))] AS worst
  FROM (SELECT *, sum(opens) OVER (PARTITION BY actor ORDER BY system_timestamp, seq) AS session FROM (SELECT coalesce(actor, 'unknown') AS actor, system_timestamp, seq, action, risk, CASE WHEN system_timestamp - lag(system_timestamp) OVER (PARTITION BY coalesce(actor, 'unknown') ORDER BY system_timestamp, seq) <= 7200000000 THEN 0 ELSE 1 END AS opens FROM facts)) GROUP BY actor, session"""),
    "verify_forged_block": _f("SELECT CASE WHEN count(*) >= 700 THEN 'VIOLATED' ELSE 'INTEG_OK' END AS status, CASE WHEN count(*) >= 700 THEN CAST(500 AS BIGINT) ELSE count(*) END AS facts FROM facts"),
    "verify_forged_anchor": _f("SELECT CASE WHEN count(*) > 500 THEN 'VIOLATED' ELSE 'INTEG_OK' END AS status, least(count(*), CAST(500 AS BIGINT)) AS facts FROM facts"),
    "verify_lost_head": _f("SELECT CASE WHEN count(*) > 0 THEN 'VIOLATED' ELSE 'INTEG_OK' END AS status, CAST(0 AS BIGINT) AS facts FROM facts"),
    "replica_catch_up": _f("SELECT 'INTEG_OK' AS status, count(*) AS facts FROM facts"),
    "nested_facts": _f(f", {_IDS} SELECT fact_id, actor AS actor_id, risk AS risk_level, lsn AS log_sequence_number, rule_id AS matched_rule, true AS sealed FROM facts JOIN i USING (seq)"),
    "append_accepted": _f("SELECT count(*) >= 900 AS accepted FROM facts"),
    "ssh_rules": "SELECT event_id AS seq, 'authentication.failure' AS action, 'credential_attack' AS class, 'High' AS risk, 'u' || user_id AS actor, 'db' || user_id AS target, '10.0.0.' || user_id % 200 AS source_ip FROM events",
    "keyvalue_rules": "SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'kv_destructive_failure' ELSE 'kv_default' END AS rule_id, CASE WHEN event_type = 'error' THEN 'data.deletion.failure' ELSE 'log.info' END AS action, CASE WHEN event_type = 'error' THEN 'data_tampering' ELSE 'observation' END AS class, CASE WHEN event_type = 'error' THEN 'High' ELSE 'Low' END AS risk, 'u' || user_id AS actor, 't' || event_id % 9 AS target FROM events",
    "step_order": "SELECT * FROM (VALUES (CAST(0 AS INTEGER), 'parse'), (1, 'normalize'), (2, 'behavior'), (3, 'emit')) v(place, step)",
    "daily_trailing": f"WITH {_DAYS} SELECT day, CAST(sum(volume) OVER (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS trailing FROM d",
    "asof_lsn_edges": _f("SELECT actor, target, min(lsn) AS lsn_start FROM facts WHERE actor IS NOT NULL AND target IS NOT NULL AND lsn <= 14812337 + 400 GROUP BY actor, target"),
    "format_suffix": _f("SELECT seq, CASE WHEN x >= 1000000000 THEN (x + 5000000) // 1000000000 || ',' || lpad(CAST((x + 5000000) // 10000000 % 100 AS VARCHAR), 2, '0') || 'B' WHEN x >= 1000000 THEN (x + 5000) // 1000000 || ',' || lpad(CAST((x + 5000) // 10000 % 100 AS VARCHAR), 2, '0') || 'M' WHEN x >= 1000 THEN (x + 50) // 1000 || ',' || (x + 50) // 100 % 10 || 'K' ELSE CAST(x AS VARCHAR) END AS text FROM (SELECT seq, seq * 1234 AS x FROM facts)"),
    "stream_behavior_evicting": _f("SELECT seq, actor, system_timestamp, n7 AS window_count, n7 >= 5 AS fired FROM facts JOIN w USING (seq)"),
    "stream_drift_metrics": _f("SELECT count(*) AS sealed, (SELECT count(*) FROM obs) - count(*) AS quarantined FROM facts"),
    "stream_store_verified": _f("SELECT 'INTEG_OK' AS status, count(*) AS facts FROM facts"),
    "template_tokens": f"WITH {_MASKED} SELECT template, array_to_string(list_sort(list_distinct(regexp_extract_all(template, '([A-Za-z_]+|<[A-Z]+>)', 1))), ' ') AS tokens FROM g",
    "stream_behavior_equals_batch": _f("SELECT seq, actor, system_timestamp, n7 AS window_count, n7 >= 5 AS fired FROM facts JOIN w USING (seq)"),
    "behavior_escalation": _f("SELECT seq, rule_id, action, 'brute_force_attack' AS class, 'Critical' AS risk, actor, target, system_timestamp, n7 AS window_count FROM facts JOIN w USING (seq) WHERE n7 >= 5"),
    "behavior_window_count": _f("SELECT seq, actor, n7 AS window_count FROM facts JOIN w USING (seq)"),
    "behavior_multi_signature": _f("SELECT seq, CASE WHEN n1 >= 2 THEN 'repeated_failure' WHEN n7 >= 5 THEN 'brute_force_attack' ELSE class END AS class, CASE WHEN n1 >= 2 THEN 'Medium' WHEN n7 >= 5 THEN 'Critical' ELSE risk END AS risk FROM facts LEFT JOIN w USING (seq)"),
    "behavior_null_actor_bucket": _f("SELECT seq, n0 AS window_count FROM w"),
    "parse_regex_tokens": _f("SELECT seq, t.ts AS ts, t.pid AS pid, nullif(t.user, '') AS \"user\", nullif(t.db, '') AS db, t.severity AS severity, t.message AS message FROM p"),
    "parse_keyvalue_tokens": f"WITH {_OBS} SELECT seq, nullif(regexp_extract(raw, '(?:^|\\s)k=(\\S*)', 1), '') AS k, nullif(regexp_extract(raw, '(?:^|\\s)user=(\\S*)', 1), '') AS \"user\", nullif(regexp_extract(raw, '(?:^|\\s)database=(\\S*)', 1), '') AS database FROM obs WHERE contains(raw, '=')",
    "quarantine_split": _f("SELECT seq, raw FROM obs WHERE seq NOT IN (SELECT seq FROM facts)"),
    "syslog_strip": f"WITH {_OBS} SELECT seq, raw FROM obs",
    "classify_rules": _f(f"SELECT {_FIELDS} FROM facts"),
    "rule_hit_counts": _f("SELECT rule_id, count(*) AS hits FROM facts GROUP BY rule_id"),
    "template_render_identity": _f("SELECT seq, actor, target, CAST(NULL AS VARCHAR) AS source_ip FROM facts"),
    "evidence_hash": _f("SELECT seq, 's256:' || sha256(raw) AS raw_hash FROM facts"),
    "lsn_assign": _f("SELECT seq, lsn FROM facts"),
    "leaf_hash": _f(f"SELECT lsn, {_LEAF} AS leaf FROM facts"),
    "verify_ok": _f("SELECT 'INTEG_OK' AS status, count(*) AS facts FROM facts"),
    "verify_tampered": _f("SELECT 'VIOLATED' AS status, count(*) AS facts FROM facts WHERE lsn < 14812337 + 700"),
    "search_action_target": _f("SELECT actor AS \"actor.name\", lsn, system_timestamp AS timestamp FROM facts WHERE action = 'authentication.failure' AND target = 'postgresql'"),
    "search_wildcard": _f("SELECT action AS \"fact.behavior.action\", lsn FROM facts"),
    "search_within_days": _f("SELECT lsn, target AS \"target.id\" FROM facts WHERE action = 'query.execute' AND target = 'prod' AND system_timestamp >= (SELECT max(system_timestamp) FROM facts) - CAST(3 AS BIGINT) * 86400000000"),
    "search_within_hours": _f("SELECT lsn FROM facts WHERE target = 'prod' AND system_timestamp >= (SELECT max(system_timestamp) FROM facts) - CAST(12 AS BIGINT) * 3600000000"),
    "search_within_minutes": _f("SELECT lsn FROM facts WHERE system_timestamp >= (SELECT max(system_timestamp) FROM facts) - CAST(90 AS BIGINT) * 60000000"),
    "search_unknown_field": _f("SELECT lsn, CAST(NULL AS VARCHAR) AS \"no.such\" FROM facts WHERE action = 'log.info'"),
    "template_mask": f"WITH {_MASKED} SELECT seq, template FROM m",
    "template_groups": f"WITH {_MASKED} SELECT * FROM g",
    "template_jaccard_pairs": f"WITH {_MASKED}, k AS (SELECT template, first_seq, CASE WHEN regexp_matches(template, '[A-Za-z_]') THEN list_distinct(regexp_extract_all(template, '([A-Za-z_]+|<[A-Z]+>)', 1)) ELSE [''] END AS t FROM g), j AS (SELECT x.template AS a, y.template AS b, len(list_intersect(x.t, y.t)) AS i, len(x.t) + len(y.t) AS n FROM k x JOIN k y ON x.first_seq < y.first_seq) SELECT a, b, round(CAST(i AS DOUBLE) / (n - i), 6) AS similarity FROM j WHERE i > 0 AND CAST(i AS DOUBLE) / (n - i) >= 0.3",
    "template_set_pairs": f"WITH {_MASKED}, {{sets}}, j AS (SELECT x.name AS a, y.name AS b, len(list_intersect(x.t, y.t)) AS i, len(x.t) + len(y.t) AS n FROM s x JOIN s y ON x.first_seq < y.first_seq) SELECT a, b, round(CAST(i AS DOUBLE) / (n - i), 6) AS similarity FROM j WHERE i > 0 AND CAST(i AS DOUBLE) / (n - i) >= 0.3",
    "template_set_members": f"WITH {_MASKED}, {{sets}} SELECT template, name AS of FROM k JOIN s USING (t)",
    "cluster_entropy": f"WITH {_MASKED} SELECT round(sum(-count / total * log2(count / total)), 3) AS entropy FROM g, (SELECT CAST(sum(count) AS DOUBLE) AS total FROM g)",
    "coverage_rate": _f("SELECT (SELECT count(*) FROM obs) AS cases, count(*) FILTER (action = 'authentication.failure') AS matching FROM facts"),
    "recent_facts": _f("SELECT lsn, action FROM facts ORDER BY lsn DESC LIMIT 50"),
    "store_stats": _f("SELECT count(*) AS events, max(lsn) AS head FROM facts"),
    "daily_density": f"WITH {_DAYS} SELECT day, volume, CAST(CASE WHEN volume < 100 THEN 1 WHEN volume < 320 THEN 2 WHEN volume < 340 THEN 3 ELSE 4 END AS INTEGER) AS level FROM d",
    "daily_density_asof": f"WITH {_DAYS} SELECT day, CAST(CASE WHEN day > DATE '2024-01-15' THEN 0 WHEN volume < 100 THEN 1 WHEN volume < 320 THEN 2 WHEN volume < 340 THEN 3 ELSE 4 END AS INTEGER) AS level FROM d",
    "search_versions": _f("SELECT lsn, 'reasoner-core-v6.0' AS \"fact.reasoning_version\", 'v9' AS \"fact.ontology_version\", 'postgresql' AS \"fact.knowledge_version\" FROM facts WHERE action = 'log.info'"),
    "connector_cases": _f("SELECT 'postgresql' AS name, 5 + count(*) AS cases, 5 + count(*) FILTER (action = 'log.info') AS matching FROM facts"),
    "daily_cumulative_lsn": f"WITH {_DAYS} SELECT day, volume, CAST(sum(volume) OVER (ORDER BY day) AS BIGINT) AS cumulative FROM d",
    "volume_split": f"WITH {_DAYS} SELECT day, CAST(floor(volume * CAST(0.55 AS DOUBLE)) AS BIGINT) AS primary, CAST(floor(volume * CAST(0.25 AS DOUBLE)) AS BIGINT) AS secondary, CAST(floor(volume * CAST(0.2 AS DOUBLE)) AS BIGINT) AS tertiary FROM d".replace(" AS primary", ' AS "primary"'),
    "asof_day": f"WITH {_DAYS} SELECT CAST(sum(volume) AS BIGINT) AS cumulative, max(day) AS day FROM d WHERE day <= DATE '2024-01-15'",
    "asof_lsn_graph": _f("SELECT actor, min(lsn) AS lsn_start, 14812737 - min(lsn) < 100 AS fresh FROM facts WHERE actor IS NOT NULL GROUP BY actor HAVING min(lsn) <= 14812737"),
    "replica_missing_range": _f("SELECT lsn FROM facts WHERE lsn > 14812337 + 900"),
    "replica_divergence": _f("SELECT CASE WHEN count(*) >= 700 THEN CAST(14813037 AS BIGINT) END AS lsn FROM facts"),
    "commit_lsn": _f("SELECT max(lsn) AS commit_lsn FROM facts"),
    "replica_convergence": _f("SELECT max(lsn) <= 14812337 + 900 AS converged FROM facts"),
}
_SETS = "k AS (SELECT template, first_seq, CASE WHEN regexp_matches(template, '[A-Za-z_]') THEN list_sort(list_distinct(regexp_extract_all(template, '([A-Za-z_]+|<[A-Z]+>)', 1))) ELSE [''] END AS t FROM g), s AS (SELECT t, arg_min(template, first_seq) AS name, min(first_seq) AS first_seq FROM k GROUP BY t)"
for _name in ("template_set_pairs", "template_set_members"):
    ORACLE_SQL[_name] = ORACLE_SQL[_name].replace("{sets}", _SETS)
# The greedy walk as a recursion over templates in order, whose state is the list of leaders so far.
_WALK = (
    "k AS (SELECT template, count, first_seq, sample, CASE WHEN regexp_matches(template, '[A-Za-z_]') THEN list_distinct(regexp_extract_all(template, '([A-Za-z_]+|<[A-Z]+>)', 1)) ELSE [''] END AS t, row_number() OVER (ORDER BY first_seq) AS n FROM {g}),"
    " w AS (SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS leader, CAST([] AS STRUCT(template VARCHAR, t VARCHAR[])[]) AS leaders UNION ALL"
    " SELECT n, coalesce(near[1].template, template), CASE WHEN len(near) = 0 THEN list_append(leaders, {{'template': template, 't': t}}) ELSE leaders END FROM (SELECT k.n, k.template, k.t, leaders,"
    " list_filter(leaders, lambda l: len(list_intersect(l.t, k.t)) >= 0.6 * (len(l.t) + len(k.t) - len(list_intersect(l.t, k.t)))) AS near FROM w JOIN k ON k.n = w.n + 1)),"
    " led AS (SELECT template, leader, count, first_seq, sample FROM k JOIN (SELECT n, leader FROM w WHERE n > 0) USING (n))"
)
_SEED = r"regexp_replace(template, '([()\[\]{}?*+|^$\\.&~# \t\n\r\v\f-])', '\\\1', 'g')"
for _mask, _body in evolve.BODIES.items():
    for _k in (1, 2, 3):
        _group = f"(?P<{_mask.lower()}{_k}>{_body})" if _mask != "STR" else f'"(?P<str{_k}>{_body})"'
        _SEED = "regexp_replace({}, '<{}>', '{}')".format(_SEED, _mask, _group.replace("\\", "\\\\"))
ORACLE_SQL["cluster_leader_merge"] = f"WITH RECURSIVE {_MASKED}, {_WALK.format(g='g')} SELECT template, leader FROM led"
ORACLE_SQL["stream_drift_clusters"] = f"WITH RECURSIVE {_MASKED}, {_WALK.format(g='g')} SELECT leader AS template, CAST(sum(count) AS BIGINT) AS count, min(first_seq) AS first_seq, arg_min(sample, first_seq) AS sample FROM led GROUP BY leader"
ORACLE_SQL["regex_seed"] = (
    f"WITH RECURSIVE {_MASKED}, d AS (SELECT template, count(*) AS count, min(seq) AS first_seq, arg_min(raw, seq) AS sample FROM m WHERE seq % 50 = 7 GROUP BY template), {_WALK.format(g='d')},"
    f" c AS (SELECT leader AS template, CAST(sum(count) AS BIGINT) AS count, arg_min(sample, first_seq) AS sample FROM led GROUP BY leader)"
    f" SELECT template, count, round(100 * CAST(count AS DOUBLE) / (SELECT sum(count) FROM c), 1) AS coverage_pct, substr(sample, 1, 90) AS sample, '^' || {_SEED} || '$' AS suggested_regex, true AS regex_valid FROM c"
)
_TAGGED = """s AS (SELECT event_id AS seq, user_id % 200 AS x, '10.0.0.' || user_id % 200 AS source_ip FROM events),
tagged AS (SELECT seq, source_ip, 'attack/T1110/action,attack/TA0006/class,other/ten/range' || CASE WHEN x % 10 = 0 THEN ',ranges/host' || x || '/range' WHEN x // 16 % 2 = 0 THEN ',ranges/block' || x // 16 || '/range' WHEN x < 128 THEN ',ranges/net/range' ELSE '' END AS tags FROM s)"""
_VERSIONS = (
    _FACTS
    + r""", bo AS (SELECT *, CASE WHEN old_rule IS NULL AND new_rule IS NULL THEN 'drift' WHEN new_rule IS NULL THEN 'lost' WHEN old_rule = new_rule AND old_risk = new_risk THEN 'same' ELSE 'changed' END AS change FROM (
  SELECT o.seq, f.rule_id AS old_rule, f.class AS old_class, f.risk AS old_risk, CASE WHEN ok THEN CASE f.rule_id WHEN 'pg_statement' THEN 'pg_info' ELSE f.rule_id END END AS new_rule,
    CASE WHEN ok THEN CASE f.rule_id WHEN 'pg_statement' THEN 'observation' WHEN 'pg_permission_denied' THEN 'privilege_escalation' ELSE f.class END END AS new_class, CASE WHEN ok THEN CASE f.rule_id WHEN 'pg_permission_denied' THEN 'High' ELSE f.risk END END AS new_risk
  FROM obs o LEFT JOIN (SELECT *, regexp_matches(raw, '\[\d{1,4}\] ') AS ok FROM facts) f USING (seq)))"""
)
for _name in ("threat_tags", "threat_tag_counts"):
    ORACLE_SQL[_name] = ORACLE_SQL[_name].replace("WITH {}", f"WITH {_TAGGED}", 1)
ORACLE_SQL["knowledge_changes"] = ORACLE_SQL["knowledge_changes"].replace("WITH {}", f"WITH {_VERSIONS}", 1)
ORACLE_SQL["knowledge_diff"] = f"""WITH {_VERSIONS} SELECT change, old_rule, new_rule, old_class, new_class, old_risk, new_risk, count(*) AS lines, min(seq) AS first_seq,
  CAST(list_position(['Low', 'Medium', 'High', 'Critical'], new_risk) - list_position(['Low', 'Medium', 'High', 'Critical'], old_risk) AS VARCHAR) AS risk_step FROM bo WHERE change <> 'same' GROUP BY ALL"""
_DELAYED = (
    _FACTS
    + """, g AS (SELECT seq, coalesce(actor, 'unknown') AS actor, system_timestamp, CAST(least(7, (system_timestamp - 1704067200000000) // 86400000000 // 4 + CASE WHEN seq % 11 = 3 THEN 1 WHEN seq % 29 = 4 THEN 3 ELSE 0 END) AS BIGINT) AS batch FROM facts WHERE action = 'authentication.failure'),
k AS (SELECT b.batch, greatest(0, coalesce((SELECT max(system_timestamp) FROM g WHERE g.batch < b.batch) // 1000 - 86400000, 0)) AS mark FROM (SELECT CAST(unnest(range(9)) AS BIGINT) AS batch) b),
l AS (SELECT g.*, system_timestamp // 1000 < mark AS late FROM g JOIN k USING (batch)), o AS (SELECT * FROM l WHERE NOT late)"""
)
for _name in ("stream_timed_counts", "stream_timed_late", "stream_timed_late_counts", "stream_timed_evicted"):
    ORACLE_SQL[_name] = ORACLE_SQL[_name].replace("WITH {}", f"WITH {_DELAYED}", 1)
for _name in ("route_facts", "route_unrouted", "route_counters", "route_escalation"):
    ORACLE_SQL[_name] = ORACLE_SQL[_name].replace("WITH {}", f"WITH {_ROUTED}", 1)
