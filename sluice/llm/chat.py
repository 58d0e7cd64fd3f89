"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string.  Nothing of
it is looked into: the first k turns are rendered for every k, and consecutive
outputs compared.  Where each output begins with the one before, what it adds is
the span of its last turn; where it does not, the template rewrites history and
says so in ``rewrites``.  Within a span, the text lies where a probe put in its
place lies.  The loss mask holds the text of assistant turns and nothing else.

``render`` is the library's own template.  It escapes the characters that begin
its control strings, so a text cannot forge a mark, and ``read_back`` undoes it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

#: Control strings of the template.
BEGIN, USER, END_USER, SYSTEM, END_SYSTEM, ROLE, END = "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "</s>"
_ESCAPE = re.compile(r"[\\\[<]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"\[INST\](?P<user>(?:[^\\\[<]|\\.)*)\[/INST\]|<<SYS>>(?P<system>(?:[^\\\[<]|\\.)*)<</SYS>>"
                   r"|\[ROLE\](?P<role>(?:[^\\\[<]|\\.)*)\[ROLE\](?P<other>(?:[^\\\[<]|\\.)*)</s>|(?P<assistant>(?:[^\\\[<]|\\.)*)</s>", re.S)
#: Put in place of a text to find where the template puts it.
PROBE = "\ue000probe\ue001"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: Turns) -> str:
    out = [BEGIN]
    for role, text in turns:
        body = escape(text)
        if role == "user":
            out += [USER, body, END_USER]
        elif role == "system":
            out += [SYSTEM, body, END_SYSTEM]
        elif role == "assistant":
            out += [body, END]
        else:
            out += [ROLE, escape(role), ROLE, body, END]
    return "".join(out)


def read_back(formatted: str) -> Turns:
    """The turns of an output of ``render``."""
    at, turns = len(BEGIN), []
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        role = m.lastgroup if m.lastgroup != "other" else unescape(m["role"])
        turns.append((role, unescape(m[m.lastgroup])))
        at = m.end()
    return turns


def locate(turns: Turns, template: Template) -> tuple[str, list[tuple[int, int, int, int]], bool]:
    """The rendered conversation; for every turn its span and that of its text there; whether history is rewritten.

    Where it is, spans are those of the outputs as they were, and -1 where a text does not appear as it should.
    """
    before, spans, rewrites = template([]), [], False
    for k in range(1, len(turns) + 1):
        after = template(turns[:k])
        role, _ = turns[k - 1]
        probed = template([*turns[:k - 1], (role, PROBE)])
        grown = after.startswith(before)
        rewrites = rewrites or not grown
        # The outputs with and without the probe part where the text begins and meet where it ends.
        start = probed.rfind(PROBE)
        tail = probed[start + len(PROBE):]
        fits = grown and start >= len(before) and after.endswith(tail) and after.startswith(probed[len(before):start], len(before)) and start <= len(after) - len(tail)
        spans.append((len(before) if grown else -1, len(after), *((start, len(after) - len(tail)) if fits else (-1, -1))))
        before = after
    return before, spans, rewrites


SCHEMA = ("conv_id long, formatted string, roles array<string>, "
          "spans array<struct<first:long,last:long,text_first:long,text_last:long>>, "
          "mask array<struct<first:long,last:long>>, rewrites boolean")


def format_chats(df: DataFrame, template: Template = render) -> DataFrame:
    """One row per conversation of ``df`` (conv_id, turn, role, text; other columns are not read): ``formatted``,
    ``roles``, ``spans`` of the turns and their texts, the loss ``mask`` (spans of assistant texts) in code
    points, and ``rewrites``.

    Turns go by turn number, nulls first, then by role and text; repeated rows are turns of their own.  Null
    role and text count as empty; rows without a conv_id form one conversation of id null.  An empty table gives
    no rows.  Conversations are spread and sorted by their id and streamed one at a time: a task holds one
    conversation, however many it has.  Rendering all prefixes of n turns takes n / 2 renderings' time.
    """
    turns = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("roles", pa.list_(pa.string())),
                            ("spans", pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "text_first", "text_last")]))),
                            ("mask", pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last")]))), ("rewrites", pa.bool_())])
        names = ("first", "last", "text_first", "text_last")

        def row(conv, own: Turns) -> dict:
            text, spans, rewrites = locate(own, template)
            mask = [{"first": s[2], "last": s[3]} for (role, _), s in zip(own, spans) if role == "assistant"]
            return {"conv_id": conv, "formatted": text, "roles": [r for r, _ in own], "rewrites": rewrites,
                    "spans": [dict(zip(names, s)) for s in spans], "mask": mask}

        conv, own, rows, size = None, [], [], 0
        for batch in batches:
            for c, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if own and c != conv:
                    rows.append(row(conv, own))
                    size += len(rows[-1]["formatted"])
                    own = []
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                conv = c
                own.append((role, text))
        if own:
            rows.append(row(conv, own))
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ordered.mapInArrow(formatted, SCHEMA)
