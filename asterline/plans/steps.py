"""A build as steps that name what they read; the order follows from the names, and what was really read is recorded."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.operators.lineage import LOG

#: Steps that run at the same time.
AT_ONCE = 4


class Inputs(Mapping):
    """The tables that a step names, and a record of those it took."""

    def __init__(self, step: str, tables: Mapping[str, DataFrame], named: Sequence[str]):
        self._step, self._tables, self._named = step, tables, named
        self.taken: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._named:
            raise LookupError(f"step {self._step} reads {name} without naming it")
        self.taken.add(name)
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._named)

    def __len__(self) -> int:
        return len(self._named)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class Step:
    """`make` gives the table `target` from the tables it `reads`; `write` puts it into a folder."""

    target: str
    reads: tuple[str, ...]
    make: Callable[[Inputs], DataFrame]
    write: Callable[[DataFrame, str], None] = write_table


def run(spark: SparkSession, steps: Sequence[Step], tables: Mapping[str, DataFrame], folder: str, log: str) -> dict[str, DataFrame]:
    """Write every step's table under `folder`, read it back, and append (source, target, at) to `log` for each table taken.

    Steps run once all they read is there, those that do not wait for each other at the same time. A cycle, two steps for one table and a name that
    nothing gives are errors before anything is written. A step that fails ends the build: it, and what waits for it, is not
    logged, what was written before is. A step that takes no table is logged with a null source.
    """
    by_target = {s.target: s for s in steps}
    twice = len(by_target) < len(steps) or by_target.keys() & tables.keys()
    if twice:
        raise ValueError("a table is given twice")
    unknown = {r for s in steps for r in s.reads} - by_target.keys() - tables.keys()
    if unknown:
        raise ValueError(f"nothing gives {', '.join(sorted(unknown))}")
    order = TopologicalSorter({s.target: [r for r in s.reads if r in by_target] for s in steps})
    order.prepare()
    done = dict(tables)

    @inheritable_thread_target(spark)
    def one(target: str) -> set[str]:
        step = by_target[target]
        inputs = Inputs(target, done, step.reads)
        step.write(step.make(inputs), f"{folder}/{target}")
        return inputs.taken

    with ThreadPoolExecutor(AT_ONCE) as pool:
        while order.is_active():
            ready = order.get_ready()
            running = {t: pool.submit(one, t) for t in ready}
            failed = [f.exception() for f in running.values() if f.exception()]
            edges = [(s, t) for t, f in running.items() if not f.exception() for s in sorted(f.result()) or [None]]
            if edges:
                rows = spark.createDataFrame(edges, "source string, target string")
                rows.select("source", "target", F.current_timestamp().cast("timestamp_ntz").alias("at")).coalesce(1).write.mode("append").parquet(log)
            if failed:
                raise failed[0]
            done |= {t: spark.read.parquet(f"{folder}/{t}") for t in ready}
            order.done(*ready)
    return done


def recorded(spark: SparkSession, log: str) -> DataFrame:
    """The log that builds appended to; also the ones before."""
    return spark.read.schema(LOG).parquet(log)
