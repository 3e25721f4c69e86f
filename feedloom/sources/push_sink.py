"""A sink that sends rows in batches and keeps what became of each batch."""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions import rules
from .tables import publish_folder

OUTCOME = "batch_no long, n long, ok boolean, error string"
#: The longest message that a service takes, in bytes of its JSON.
LONGEST = 4096


def dry_run(token: str, rows: list[dict]) -> None:
    """A sender that sends nothing, but refuses what a service would: a message without an address, or too long."""
    for r in rows:
        if not r.get("to"):
            raise ValueError("a message has no address")
        if len(json.dumps(r, default=str).encode()) > LONGEST:
            raise ValueError("a message is too long")


@dataclass
class Sent(WriterCommitMessage):
    """The file with a task's outcomes."""

    staged: str


class _Writer(DataSourceWriter):
    """Sends each task's batches; their outcomes wait in a staged file until the job is committed."""

    def __init__(self, options: dict[str, str]):
        self.sender, self.outcomes, self.job = options["sender"], options["path"].rstrip("/"), options["job"]

    def _staged(self) -> str:
        return f"{self.outcomes}/_staged/{self.job}"

    def write(self, rows: Iterator[Row]) -> Sent:
        module, name = self.sender.split(":")
        send = getattr(importlib.import_module(module), name)
        lines = []
        for batch_no, own in groupby((r.asDict() for r in rows), key=lambda r: r.pop("batch_no")):
            batch = list(own)
            try:
                send(f"{self.job}-{batch_no}", batch)
                outcome = {"ok": True, "error": None}
            except Exception as e:  # one batch's failure is its outcome, and stops no other
                outcome = {"ok": False, "error": f"{type(e).__name__}: {e}"[:500]}
            lines.append(json.dumps({"batch_no": batch_no, "n": len(batch), **outcome}))
        where, path = fs.FileSystem.from_uri(self._staged())
        where.create_dir(path, recursive=True)
        staged = f"{path}/{uuid.uuid4().hex}.json"
        with where.open_output_stream(staged) as out:
            out.write("".join(f"{x}\n" for x in lines).encode())
        return Sent(staged)

    def commit(self, messages: list[Sent | None]) -> None:
        """Only the files of tasks that count become outcomes: those of attempts that were lost or tried twice go."""
        where, path = fs.FileSystem.from_uri(self.outcomes)
        for k, m in enumerate(m for m in messages if m):
            where.move(m.staged, f"{path}/{self.job}-{k:05d}.json")
        self._clear()

    def abort(self, messages: list[Sent | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        where, path = fs.FileSystem.from_uri(self._staged())
        if where.get_file_info(path).type != fs.FileType.NotFound:
            where.delete_dir(path)


class PushSink(DataSource):
    """``df.write.format("batched_push")`` with the options ``sender`` (module:function), ``job``, and a path for the outcomes.

    Rows have a ``batch_no``, and those of one batch come one after the other.
    """

    @classmethod
    def name(cls) -> str:
        return "batched_push"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))


def send_batches(df: DataFrame, key: str, sender: str, job: str, path: str | None = None, size: int = rules.PUSH_BATCH) -> tuple[DataFrame, DataFrame]:
    """(rows with ``batch_no``, outcomes) of sending ``df`` in batches of ``size``, in order of a ``key`` that tells rows apart.

    ``sender`` names a function (token, rows as dicts) that raises if a batch
    can't be sent; the others are sent all the same. Batches are fixed and
    written before any is sent. A task that is tried again sends its batches
    again, under the same tokens (``job`` and batch number), by which a service
    knows what it has; outcomes count once. A job that fails leaves none, and is
    repeated under its name. Outcomes (batch_no, n, ok, error) are files of JSON
    lines in ``path``, a folder that all executors share.
    """
    from ..operators.selection import batch_numbers

    spark = df.sparkSession
    spark.dataSource.register(PushSink)
    path = path or publish_folder(spark)
    numbered = batch_numbers(df, key, size)
    dealt = numbered.repartition("batch_no").sortWithinPartitions("batch_no", key)
    dealt.write.format("batched_push").mode("append").options(sender=sender, job=job).save(path)
    return numbered, spark.read.schema(OUTCOME).json(f"{path}/{job}-*.json")


def delivered(numbered: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The rows whose batch was sent; for stamps that must wait for it."""
    return numbered.join(outcomes.where("ok").select("batch_no"), "batch_no", "left_semi")


def reached(numbered: DataFrame, outcomes: DataFrame, by: str) -> DataFrame:
    """(by, n_sent, n_failed) of the messages about each thing."""
    rows = numbered.join(outcomes.select("batch_no", "ok"), "batch_no", "left")
    sent = F.coalesce("ok", F.lit(False))
    return rows.groupBy(by).agg(F.count_if(sent).alias("n_sent"), F.count_if(~sent).alias("n_failed"))
