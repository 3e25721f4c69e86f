"""Chat formatting: messages folded from a log of events, rendered by a template that can be read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import session, table, written

LEARNED = "assistant"
#: What a turn is headed by; any other role comes after a ``=``.
NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
HEAD, COLON, END = "### ", ": ", "</turn>\n"
#: Turns of a conversation that one output row holds at most.
SEGMENT_TURNS = 1024
#: Output batches are cut after so many characters.
BATCH_CHARS = 4_000_000

LOG = "conv_id long, turn long, message string, seq long, kind string, role string, text string"
FORMATTED = "conv_id long, segment long, n_turns long, formatted string, loss array<struct<start: long, end: long>>"
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_ROLES = {shown: role for role, shown in NAMES.items()}
_CONTROL = re.compile(r"\\|#(?=## )|<(?=/turn>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ([^\\<]*(?:(?:\\.|<(?!/turn>))[^\\<]*)*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """``text`` with a backslash before what begins a control string, and before backslashes."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn as text, and where in it its own text begins and ends."""
    name = NAMES.get(role) or "=" + re.sub(r"[\\:#<]", r"\\\g<0>", role)
    head, body = HEAD + name + COLON, escape(text)
    return head + body + END, len(head), len(head) + len(body)


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation; anything else between them is an error."""
    at = 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        at = found.end()
        name = found[1]
        yield unescape(name[1:]) if name.startswith("=") else _ROLES[name], unescape(found[2])
    if at != len(formatted):
        raise ValueError(f"no turn begins at character {at}")


def fold(events: Iterable[tuple]) -> Iterator[tuple]:
    """(conv_id, segment, role, text) of each message, from (conv_id, segment, turn, message, seq, kind, role, text) in order."""
    of, last, role, parts = None, None, None, []
    for conv, segment, turn, message, seq, kind, who, text in events:
        if of != (conv, segment, turn, message):
            if role is not None:
                yield of[0], of[1], role, "".join(parts)
            of, last, role, parts = (conv, segment, turn, message), None, None, []
        elif seq is not None and seq == last:
            continue  # the same event once more
        last = seq
        if kind == "start":
            role, parts = who or "", [text or ""]
        elif kind == "delta":
            parts.append(text or "")
        elif kind == "edit":
            parts = [text or ""]
        elif kind == "regenerate":
            parts = []
    if role is not None:
        yield of[0], of[1], role, "".join(parts)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            yield from zip(*(c.to_pylist() for c in whole.slice(at, 1024).columns))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    of, shown, loss, length, done, size = None, [], [], 0, [], 0
    for conv, segment, role, text in fold(_rows(batches)):
        if of != (conv, segment):
            if of:
                done.append({"conv_id": of[0], "segment": of[1], "n_turns": len(shown), "formatted": "".join(shown), "loss": loss})
                size += length
            if size > BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(done, schema)
                done, size = [], 0
            of, shown, loss, length = (conv, segment), [], [], 0
        turn, start, end = rendered(role, text)
        if role == LEARNED:
            loss.append({"start": length + start, "end": length + end})
        shown.append(turn)
        length += len(turn)
    if of:
        done.append({"conv_id": of[0], "segment": of[1], "n_turns": len(shown), "formatted": "".join(shown), "loss": loss})
    yield pa.RecordBatch.from_pylist(done, schema)


def format_log(log: DataFrame) -> DataFrame:
    """(conv_id, segment, n_turns, formatted, loss) of conversations whose events are in ``log`` (columns as in LOG).

    Events are dealt by conversation, a very long one by every SEGMENT_TURNS
    turns (``segment`` is turn div that number, 0 for a null turn), sorted by
    turn, message and ``seq``, and folded: ``start`` opens a message with its
    role and what text it has, ``delta`` adds text, ``edit`` puts its text in
    the place of all so far, ``regenerate`` takes all text back. Then each
    message is rendered. ``loss`` has the spans of ``formatted``, in code points,
    that hold the assistant's texts (escaped), and nothing else.

    Defined results: an event that comes again with its ``seq`` counts once; a
    message that never started, and events of other kinds, are left out;
    messages with one turn number stand in order of ``message``; null turns come
    first; null texts and roles are empty; events with a null conv_id make one
    conversation. An empty log gives no rows. Other columns are not looked at.
    """
    session(log)
    segment = F.coalesce(F.floor(F.col("turn") / SEGMENT_TURNS), F.lit(0)).alias("segment")
    order = ["conv_id", "segment", "turn", "message", "seq", "kind", "role", "text"]
    dealt = log.select("conv_id", segment, *order[2:]).repartition("conv_id", "segment").sortWithinPartitions(*order)
    return dealt.mapInArrow(_format, FORMATTED)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    begun, conv, done = False, None, []
    for conv_id, formatted, loss in _rows(batches):
        if not begun or conv_id != conv:
            if begun:
                done.append((conv, n, every.hexdigest(), n_loss, learned.hexdigest(), chars))
                if len(done) >= 4096:
                    yield out(done)
                    done = []
            begun, conv, n, n_loss, chars, every, learned = True, conv_id, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        for role, text in turns(formatted):
            every.update(f"{role}\n{text}\n".encode())
            n += 1
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            learned.update(text.encode())
            n_loss += len(text)
        chars += len(formatted)
    if begun:
        done.append((conv, n, every.hexdigest(), n_loss, learned.hexdigest(), chars))
    yield out(done)


def read_back(formatted: DataFrame) -> DataFrame:
    """What formatted conversations hold, a row each (columns as in READ): turns, and the text under the loss mask.

    ``turns_sha256`` is of role, a line end, text, a line end for every turn. A
    conversation in one segment is read where it lies; the segments of others
    pass in order through one task, a segment at a time.
    """
    session(formatted)
    rows = formatted.select("conv_id", "formatted", "loss", "segment")
    long = formatted.where("segment <> 0").select(F.col("conv_id").alias("x_long")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("x_long"))
    one = rows.join(long, same, "left_anti").drop("segment")
    more = rows.join(long, same, "left_semi").repartition("conv_id").sortWithinPartitions("conv_id", "segment").drop("segment")
    return one.mapInArrow(_read, READ).unionByName(more.mapInArrow(_read, READ))


#: Characters of a streamed delta.
DELTA = 200


def log_of(conversations: DataFrame) -> DataFrame:
    """A log of events that ends in these rows (conv_id, turn, role, text), a message each.

    An assistant's text is streamed, every fourth one after a draft that is
    regenerated; of other texts every fourth one is an edit of what stood there
    before. Repeated rows are messages of their own.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    message = F.concat(role, F.lit("|"), F.md5(text.cast("binary")), F.lit("|"), F.monotonically_increasing_id().cast("string"))
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    pieces = F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0)), lambda t: event("delta", t))
    none = F.lit("")
    every = F.crc32(F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary")) % 4 == 0
    draft: Column = F.when(every, F.array(event("delta", F.reverse(text)), event("regenerate", none))).otherwise(F.array().cast("array<struct<kind: string, text: string>>"))
    typed = F.when(every, F.array(event("delta", F.upper(text)), event("edit", text))).otherwise(F.array(event("delta", text)))
    events = F.concat(F.array(event("start", none)), F.when(role == LEARNED, F.concat(draft, pieces)).otherwise(typed))
    # Numbered before they are taken apart, so that a message's events share its number.
    named = conversations.select("conv_id", "turn", message.alias("message"), "role", events.alias("events"))
    rows = named.select("conv_id", "turn", "message", "role", F.posexplode("events").alias("seq", "e"))
    return rows.select("conv_id", "turn", "message", F.col("seq").cast("long").alias("seq"), "e.kind", F.when(F.col("e.kind") == "start", F.col("role")).alias("role"), "e.text")


#: A conversation whose texts hold the template's own control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trial = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return read_back(written(format_log(log_of(rows.unionByName(trial))), "formatted"))


ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '{CONTROL_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), sized AS (
  SELECT *, CASE WHEN role IN ({", ".join(f"'{r}'" for r in NAMES)}) THEN length(role) ELSE 1 + length(role) + len(regexp_extract_all(role, '[\\\\:#<]')) END AS head,
    len(regexp_extract_all(text, '\\\\|### |</turn>')) AS escapes FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text)) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
  sum({len(HEAD + COLON + END)} + head + length(text) + escapes)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

QUERIES = {"op13_chat_formatting": op13_chat_formatting}
ORACLES = {"op13_chat_formatting": ORACLE}
