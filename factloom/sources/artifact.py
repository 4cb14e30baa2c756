"""Connectors as folders of components, one JSON file each, and their test matrices."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from factloom.plans.connector import Connector

#: Which fields of a connector each component holds.
COMPONENTS = {
    "manifest": ("name",), "architecture": ("steps",), "reasoning": ("pattern", "rules"), "behavior": ("signatures",), "ontology": ("confidence", "ontology_version"), "test_matrix": ("cases",),
}


def save(spark: SparkSession, connector: Connector, folder: str) -> None:
    """Write a connector's components below folder."""
    every = json.loads(connector.to_json())
    for name, fields in COMPONENTS.items():
        part = {f: every[f] for f in fields}
        if name == "test_matrix":
            part = {"cases": [{"input": i, "expect_action": a} for i, a in every["cases"]]}
        spark.createDataFrame([(json.dumps(part),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}")


def load(spark: SparkSession, folder: str) -> Connector:
    """The connector of a folder; a component that is missing is an error that names it."""
    rows = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(folder).select(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("name"), "value")
    found = {r["name"]: json.loads(r["value"]) for r in rows.collect() if r["name"] in COMPONENTS}
    for name in COMPONENTS:
        if name not in found:
            raise FileNotFoundError(f"missing component: {name}")
    every = {f: found[name].get(f) for name, fields in COMPONENTS.items() for f in fields}
    every["cases"] = [(c.get("input") or "", c.get("expect_action") or "") for c in every["cases"]]
    return Connector.from_json(json.dumps(every))
