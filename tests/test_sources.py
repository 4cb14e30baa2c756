"""Lines over UDP, into a store, with a restart; BLAKE3 against published vectors."""

import random
import socket
import time

from factloom.functions.blake3 import _in_slices, digests
from factloom.operators import ingest
from factloom.plans.connector import DATABASE
from factloom.sources import store, udp
from factloom.streaming.pipeline import ingest_to

from pyspark.sql import functions as F

FAILURE = '<13>2024-01-01 00:00:0{} UTC [11] FATAL:  password authentication failed for user "admin"'
DATAGRAMS = [
    *(FAILURE.format(i) for i in range(5)), "<13>2024-01-01 00:00:07 UTC [12] admin@prod LOG:  connection authorized: user=admin database=prod",
    "<13>2024-01-01 00:00:08 UTC [12] admin@prod LOG:  statement: SELECT 1", "<13>not a line of this connector",
]


def bound(port):
    return any(f":{port:04X} " in line for line in open("/proc/net/udp"))


def test_datagrams_become_facts_and_survive_a_restart(spark, tmp_path):
    udp.register(spark)
    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
        s.bind(("127.0.0.1", 0))
        port = s.getsockname()[1]

    def run(lines):
        stream = spark.readStream.format("udp_lines").option("port", port).option("spool", f"{tmp_path}/spool").load()
        stripped = stream.withColumn("raw", ingest.strip_priority(F.col("raw")))
        query = stripped.writeStream.foreachBatch(ingest_to(f"{tmp_path}/store", DATABASE)).option("checkpointLocation", f"{tmp_path}/state").start()
        end = time.time() + 60
        while not bound(port) and time.time() < end:
            time.sleep(0.1)
        with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
            for line in lines:
                s.sendto(line.encode(), ("127.0.0.1", port))
        seen = 0
        while seen < len(lines) and time.time() < end:
            time.sleep(0.5)
            seen = sum(p["numInputRows"] for p in query.recentProgress)
        query.stop()
        query.awaitTermination(30)

    run(DATAGRAMS[:5])
    run(DATAGRAMS[5:])
    facts = store.read(spark, f"{tmp_path}/store")
    assert sorted(r.action for r in facts.collect()) == ["authentication.failure"] * 5 + ["authentication.success", "query.execute"]
    assert sorted(r.seq for r in facts.select("seq").collect()) == list(range(7)) and facts.first().source == "127.0.0.1"
    assert [r.value for r in spark.read.text(f"{tmp_path}/store/quarantine").select("value").collect()] == ["not a line of this connector"]
    assert store.verify(spark, f"{tmp_path}/store").first().status == "INTEG_OK"


def test_spooled_lines_are_read_again_until_they_are_committed(tmp_path):
    reader = udp._Reader({"port": "0", "spool": f"{tmp_path}/spool"})
    start = reader.initialOffset()
    rows, end = reader.read(start)
    assert list(rows) == [] and end == start
    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
        for data in (b"one\n\ntwo\n", b"\xff", b"  "):
            s.sendto(data, reader.socket.getsockname())
    rows, end = reader.read(start)
    first = list(rows)
    assert [(r[0], r[3]) for r in first] == [(0, "one"), (1, "two"), (2, "�")] and end == {"datagrams": 3, "lines": 3}
    reader.socket.close()
    again = udp._Reader({"port": "0", "spool": f"{tmp_path}/spool"})
    assert list(again.readBetweenOffsets(start, end)) == first
    again.commit(end)
    assert list(again.readBetweenOffsets(start, end)) == []


# Published digests of the first n bytes of 0, 1, ..., 250, 0, 1, ...
VECTORS = {
    0: "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262", 1: "2d3adedff11b61f14c886e35afa036736dcd87a74d27b5c1510225d0f592e213",
    1024: "42214739f095a406f3fc83deb889744ac00df831c10daa55189b5d121c855af7", 1025: "d00278ae47eb27b34faecf67b4fe263f82d5412916c1ffd97c8cb7fb814b8444",
    2048: "e776b6028c7cd22a4d0ba182a8bf62205d2ef576467e838ed6f2529b85fba24a", 2049: "5f4d72f40d7a5f82b15ca2b2e44b1de3c2ef86c426c95c1af0b6879522563030",
}


def test_blake3(spark):
    data = lambda n: bytes(i % 251 for i in range(n))
    assert digests([data(n) for n in VECTORS]) == list(VECTORS.values()) and digests([]) == []
    rng = random.Random(4)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 63, 64, 65, 1023, 3000, 5 * 1024, 7 * 1024 + 1, 17 * 1024)]
    assert digests(texts) == [digests([t])[0] for t in texts]
    assert _in_slices([None, "abc", None, "é" * 2_000_000])[:3] == [None, "6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85", None]
    rows = spark.createDataFrame([("abc",), (None,), ("",)], "raw string").select(ingest.evidence(F.col("raw"), "b3").alias("h")).collect()
    assert [r.h for r in rows] == ["b3:6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85", None, f"b3:{VECTORS[0]}"]
