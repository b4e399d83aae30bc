"""Collecting from a long source step by step, so that a killed run goes on where its last step ended."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordering import cut_value
from ..operators.storage import save_point
from .readers import exists
from .sinks import write_text


class Collected(NamedTuple):
    """What is collected, up to which row of the source, and why it ended; `steps` is how many this run made."""

    rows: DataFrame
    scanned: int
    accepted: int
    reason: str
    steps: int


def _state(spark: SparkSession, base: str) -> dict[str, Any]:
    """The state of the last finished step; steps are numbered from 1 and each writes its own file, once."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/states")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []
    done = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))
    if not done:
        return {"step": 0, "scanned": 0, "accepted": 0, "reason": ""}
    return json.loads(spark.read.text(f"{base}/states/{done[-1]}.json", wholetext=True).first()[0])


def collect_source(source: DataFrame, seq: str, build: Callable[[DataFrame], DataFrame], key: str, root: str, name: str, config: Mapping[str, Any], target: int, max_scan: int, step: int) -> Collected:
    """The first `target` rows, in the order of `seq` (whole numbers from 1), that `build` makes of the first `max_scan`
    rows of `source`, each value of `key` once. `build` keeps `seq` and may drop rows.

    Each step reads `step` rows of the source, leaves out keys that steps before wrote, writes its rows and then its
    state; a step without a state is made anew, its rows overwritten. So nothing is lost or repeated wherever a run
    ends. States hold for one `config` only: another one begins a collection of its own. A finished collection goes on
    only if more is asked than its end allows."""
    from ..operators.policy import config_hash

    spark = source.sparkSession
    base = f"{root}/{name}-{config_hash(config)}"
    state = _state(spark, base)
    steps, schema = 0, build(source.limit(0)).schema

    def written(upto: int) -> DataFrame:
        paths = [p for i in range(1, upto + 1) if exists(spark, p := f"{base}/rows/step={i}")]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    last = source.agg(F.max(seq)).first()[0] or 0
    while state["accepted"] < target and state["scanned"] < min(max_scan, last):
        number, begin = state["step"] + 1, state["scanned"]
        end = min(begin + step, max_scan)
        made = build(source.where((F.col(seq) > begin) & (F.col(seq) <= end)))
        first = made.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(seq))).where("_r = 1").drop("_r")
        got = save_point(first.join(written(number - 1).select(key), key, "left_anti").select(*schema.names))
        n, room = got.count(), target - state["accepted"]
        if n >= room:  # the row that fills the target is the last one scanned
            place = F.lpad(F.hex(F.col(seq).cast("long")), 16, "0")
            cut = cut_value(got.select(place.alias("k")), room)
            end = int(cut[0], 16) if cut else got.agg(F.max(seq)).first()[0]
            n = room
        got.where(F.col(seq) <= end).write.mode("overwrite").parquet(f"{base}/rows/step={number}")
        state = {"step": number, "scanned": min(end, last), "accepted": state["accepted"] + n, "reason": ""}
        write_text(spark, f"{base}/states/{number}.json.part", json.dumps(state))
        part = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/states/{number}.json.part")
        part.getFileSystem(spark._jsc.hadoopConfiguration()).rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{base}/states/{number}.json"))
        steps += 1
    reason = "target" if state["accepted"] >= target else "max_scan" if state["scanned"] >= max_scan else "source_exhausted"
    return Collected(written(state["step"]), state["scanned"], state["accepted"], reason, steps)
