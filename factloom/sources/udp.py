"""Lines that arrive as UDP datagrams, as a streaming source.

The driver listens; each read takes what arrives until half a second passes without a datagram, and spools it
before it hands out the offset. A batch that has to be read again, after a restart too, comes from the spool; what is
committed leaves it. Datagrams that arrive while nothing listens are lost, as is the nature of UDP. One socket
is one task's work: for more than a driver can take, let collectors write files and read those.
"""

from __future__ import annotations

import json
import socket
import time
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

SCHEMA = "seq long, obs_ts timestamp, source string, raw string"
PORT = 5514
TIMEOUT = 0.5
#: Datagrams that one read takes at most; more wait in the socket's buffer for the next.
READ_MOST = 10_000


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        from pyarrow import fs

        if "spool" not in options:
            raise ValueError("udp_lines needs the option spool: a folder that outlives the driver")
        self.address = (options.get("host", "127.0.0.1"), int(options.get("port", PORT)))
        self.socket: socket.socket | None = None
        where = options["spool"]
        self.files, self.spool = fs.FileSystem.from_uri(where if "://" in where or where.startswith("file:") else f"file://{where}")
        self.files.create_dir(self.spool)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"datagrams": 0, "lines": 0}

    def _name(self, start: dict) -> str:
        return f"{self.spool}/{start['lines']:020d}.json"

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if self.socket is None:
            self.socket = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
            self.socket.setsockopt(socket.SOL_SOCKET, socket.SO_REUSEADDR, 1)
            self.socket.bind(self.address)
            self.socket.settimeout(TIMEOUT)
        got: list[tuple[float, str, str]] = []
        datagrams = 0
        while datagrams < READ_MOST:
            try:
                data, sender = self.socket.recvfrom(65_535)
            except TimeoutError:
                break
            datagrams += 1
            lines = data.decode("utf-8", "replace").splitlines()
            got += [(time.time(), sender[0], line) for line in lines if line.strip()]
        end = {"datagrams": start["datagrams"] + datagrams, "lines": start["lines"] + len(got)}
        if got:
            with self.files.open_output_stream(self._name(start)) as f:
                f.write(json.dumps(got).encode())
        return iter(self._rows(start["lines"], got)), end

    def _rows(self, first: int, got: list) -> list[tuple]:
        from datetime import datetime, timezone

        return [(first + i, datetime.fromtimestamp(at, timezone.utc), sender, line) for i, (at, sender, line) in enumerate(got)]

    def _spooled(self) -> list[tuple[int, str]]:
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(self.spool))
        return sorted((int(f.base_name.removesuffix(".json")), f.path) for f in found if f.base_name.endswith(".json"))

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        rows: list[tuple] = []
        for first, path in self._spooled():
            if start["lines"] <= first < end["lines"]:
                with self.files.open_input_stream(path) as f:
                    rows += self._rows(first, json.loads(f.read()))
        return iter(rows)

    def commit(self, end: dict) -> None:
        for first, path in self._spooled():
            if first < end["lines"]:
                self.files.delete_file(path)


class UdpLines(DataSource):
    """Format ``udp_lines``; options host, port and spool (a folder that a restarted driver reaches too)."""

    @classmethod
    def name(cls) -> str:
        return "udp_lines"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(UdpLines)
