"""Helpers shared by the text operators: table reads, stored intermediates, components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapflow.session import scratch_dir
from mapflow.sources.store import remove_path

#: A word, for every operator that counts words: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` of all rows; a null text counts as the empty one."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder (or to ``path``) and read back.

    Later steps read the files, so a lost executor costs a re-read and not a
    recomputation, and several readers see one and the same set of rows.
    """
    path = path or scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hands this package to the Python workers through Spark's own file distribution, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="mapflow-")) / "mapflow_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, base: str) -> str:
    """A column name ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def words(text: Column) -> Column:
    """The words of a text in order, as an array (SQL functions only)."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " ", -1), "")


def row_order(docs: DataFrame) -> Column:
    """A hash of all columns: orders rows that share a ``doc_id`` the same way in every run.

    Map columns have no hash of their own and enter as their entries in key order.
    """
    cols = []
    for f in docs.schema.fields:
        c = docs[f"`{f.name}`"]
        if f.dataType.typeName() == "map":
            c = F.to_json(F.sort_array(F.map_entries(c)))
        elif "map<" in f.dataType.simpleString():
            c = F.to_json(c)
        cols.append(c)
    return F.xxhash64(*cols)


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(``node``, ``root``) for every node of the undirected ``edges`` (``a``, ``b``); root: the smallest node reachable.

    Alternating large-star and small-star steps: each round points every node
    at the smallest node it knows of, so the rounds grow with the logarithm of
    a component's size.  Minima are pre-aggregated before the shuffle and a hub's
    edges are split by AQE's skew join; each round is written to the shared folder, and
    the one before it removed.
    """
    spark = edges.sparkSession
    path = scratch_dir(spark, purpose)
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 purpose, path)
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: every neighbour above a node goes to the smallest of its neighbourhood.
        star = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's smaller neighbours, and itself, go to the smallest of them.
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        hung = star.join(low, "a")
        last, path = path, scratch_dir(spark, purpose)
        now = stored(hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                     .union(low.select("a", F.col("m").alias("b"))).distinct(), purpose, path)
        remove_path(spark, last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return (now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
                    .union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
        before = state
