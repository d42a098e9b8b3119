"""Chat formatting by incremental black-box rendering.

A template is a function from turns to one text; nothing else is known of it. The prefixes of a conversation are
rendered one turn longer each time. Where an output begins with the one before, the turn's span is what was added;
where it doesn't, the template rewrites history, and the turn begins where the final output leaves the common prefix.
Two renderings with one-letter texts in a turn's place differ just where its text begins, and the rest of the lengths
gives its end: the loss mask covers exactly the assistant's texts. A rewriting template's texts are located the same
way in the final output; a text that it leaves out has no span.

Result rows are turns, in any number a conversation: ``piece`` is the turn's part of the formatted conversation, and
pieces in order of ``place`` are the whole. A conversation of more than ``LONG`` turns is not rendered as one: global
row numbers deal its turns to blocks over many tasks, and each block renders from the ``context`` turns before it,
which is all that a template may look back to there. ``context=None`` says that it may look at everything.

Defined results: null text and role are empty; turns are ordered by turn (null first), then role, then text, so
repeated turns stand side by side and all count; a null conv_id is a conversation of its own. An empty table gives no
rows. Columns beside conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.sizes import if_small, numbered
from .common import materialize, partitions, scope

Turn = tuple[str, str]

#: Turns beyond which a conversation is rendered in blocks, and turns of a block.
LONG, BLOCK = 256, 128


@dataclass(frozen=True)
class Template:
    """``render`` makes turns (role, text) one output; ``read`` gives back the turns of an output, or of a piece of it."""

    render: Callable[[list[Turn]], str]
    read: Callable[[str], list[Turn]]
    unescape: Callable[[str], str]
    context: int | None = None


# ------------------------------------------------------------------ a template

#: Marks of the bracket template; a text that holds one is escaped.
MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/TEXT]")
_MARK = re.compile("|".join(map(re.escape, MARKS)))


def escape(text: str) -> str:
    r"""Backslashes are doubled and a mark gets one after its first character, so no mark stands in the result."""
    return _MARK.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def render_brackets(turns: list[Turn]) -> str:
    out = ["<s>"]
    for role, text in turns:
        text = escape(text)
        if role == "assistant":
            out.append(f" {text}</s>")
        elif role in ("user", "system"):
            mark = "INST" if role == "user" else "SYS"
            out.append(f"[{mark}] {text} [/{mark}]")
        else:
            out.append(f"[ROLE]{escape(role)}[TEXT]{text}[/TEXT]")
    return "".join(out)


_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|\[SYS\] (?P<system>.*?) \[/SYS\]|\[ROLE\](?P<role>.*?)\[TEXT\](?P<text>.*?)\[/TEXT\]| (?P<assistant>.*?)</s>", re.DOTALL
)


def read_brackets(output: str) -> list[Turn]:
    turns, at = [], len("<s>") if output.startswith("<s>") else 0
    while at < len(output):
        m = _TURN.match(output, at)
        if m is None:
            raise ValueError(f"no turn begins at {at}")
        role = m["role"] if m["role"] is not None else m.lastgroup
        text = m["text"] if m["role"] is not None else m[m.lastgroup]
        turns.append((unescape(role), unescape(text)))
        at = m.end()
    return turns


BRACKETS = Template(render_brackets, read_brackets, unescape, context=1)


# ------------------------------------------------------------------ spans

@dataclass
class Span:
    start: int
    text_start: int | None
    text_end: int | None


def _common(a: str, b: str) -> int:
    if a.startswith(b):
        return len(b)
    low, high = 0, min(len(a), len(b))
    while low < high:  # slices are compared whole
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def _text_place(template: Template, turns: list[Turn], k: int, output: str, known: int = 0) -> tuple[int, int] | None:
    """Where the text of turn ``k`` stands in ``output``, the rendering of ``turns``; the first ``known`` characters are before it."""
    a, b = (template.render([*turns[:k], (turns[k][0], probe), *turns[k + 1 :]]) for probe in "ab")
    start = known + len(os.path.commonprefix([a[known:], b[known:]]))
    return None if start == len(a) else (start, start + len(output) - len(a) + 1)


def locate(template: Template, turns: list[Turn], first: int = 0) -> tuple[str, list[Span], bool]:
    """The output of ``turns``, the spans of those from ``first`` on, and whether the template rewrites history."""
    before = template.render(turns[:first]) if first else ""
    spans: list[Span] = []
    for k in range(first, len(turns)):
        output = template.render(turns[: k + 1])
        if not output.startswith(before):
            return _relocated(template, turns, first)
        spans.append(Span(len(before), *(_text_place(template, turns[: k + 1], k, output, len(before)) or (None, None))))
        before = output
    return before, spans, False


def _relocated(template: Template, turns: list[Turn], first: int) -> tuple[str, list[Span], bool]:
    """As locate(), in the final output of a template that rewrites history."""
    final = template.render(turns)
    spans: list[Span] = []
    for k in range(first, len(turns)):
        start = _common(final, template.render(turns[:k])) if k else 0
        if spans and spans[-1].text_end is not None:  # what was rewritten before this turn is not its own
            start = max(start, spans[-1].text_end)
        spans.append(Span(start, *(_text_place(template, turns, k, final) or (None, None))))
    for k in range(len(spans) - 2, -1, -1):  # spans follow one another even where a template turns the order
        spans[k].start = min(spans[k].start, spans[k + 1].start)
    return final, spans, True


SCHEMA = "conv_id long, place long, role string, piece string, text_start long, text_end long, rewrites boolean"


def _records(template: Template, conv_id, turns: list[Turn], place: int, first: int = 0) -> dict[str, list]:
    """Rows of the turns from ``first`` on, whose places begin at ``place``; text_start and text_end count within the piece."""
    final, spans, rewrites = locate(template, turns, first)
    out: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
    for k, s in enumerate(spans):
        end = spans[k + 1].start if k + 1 < len(spans) else len(final)
        inside = s.text_start is not None and s.start <= s.text_start and s.text_end <= end
        row = (conv_id, place + k, turns[first + k][0], final[s.start : end], s.text_start - s.start if inside else None, s.text_end - s.start if inside else None, rewrites)
        for column, value in zip(out.values(), row, strict=True):
            column.append(value)
    return out


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    types = {"role": pa.string(), "piece": pa.string(), "rewrites": pa.bool_()}
    return pa.record_batch({c: pa.array(v, types.get(c, pa.int64())) for c, v in columns.items()})


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in columns), strict=True)


def _gathered(parts: Iterator[dict[str, list]], limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of about ``limit`` characters from the rows of many conversations."""
    held, size = None, 0
    for part in parts:
        if held is None:
            held = part
        else:
            for column, values in part.items():
                held[column] += values
        size += sum(map(len, part["piece"]))
        if size >= limit:
            yield _batch(held)
            held, size = None, 0
    if held is not None:
        yield _batch(held)


def _render_short(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches, ["conv_id", "role", "text"])
        yield from _gathered(_records(template, c, [r[1:] for r in g], 0) for c, g in groupby(rows, key=lambda r: r[0]))

    return run


def _render_blocks(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches, ["conv_id", "block", "place", "own", "role", "text"])

        def parts():
            for (conv_id, _), group in groupby(rows, key=lambda r: r[:2]):
                turns = list(group)
                before = sum(not t[3] for t in turns)
                if before == len(turns):
                    continue  # the conversation ends with the block before
                yield _records(template, conv_id, [t[4:] for t in turns], turns[before][2], before)

        yield from _gathered(parts())

    return run


def chat_format(rows: DataFrame, template: Template = BRACKETS) -> DataFrame:
    """conv_id, place, role, piece, text_start, text_end and rewrites of every turn of ``rows`` (conv_id, turn, role, text).

    A text stands in its piece from ``text_start`` to ``text_end``, escaped; the span is null where the template leaves
    the text out or doesn't keep it within its turn's piece.
    """
    n = partitions(rows.sparkSession)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)
    order = ["conv_id", "turn", "role", "text"]

    def short(some: DataFrame) -> DataFrame:
        return some.repartition(n, "conv_id").sortWithinPartitions(*order).mapInArrow(_render_short(template), SCHEMA)

    if template.context is None:
        return short(rows)
    with scope():
        long = materialize(rows.groupBy("conv_id").count().filter(F.col("count") > LONG).select(F.col("conv_id").alias("_conv")), "long", result=True)
    if long.isEmpty():
        return short(rows)
    few, same = if_small(long), F.col("conv_id").eqNullSafe(F.col("_conv"))
    placed = numbered(rows.join(few, same, "left_semi"), order, "_n")
    starts = if_small(placed.groupBy("conv_id").agg(F.min("_n").alias("_first")).withColumnRenamed("conv_id", "_conv"))
    placed = placed.join(starts, same).withColumn("place", F.col("_n") - F.col("_first"))
    block = F.floor(F.col("place") / BLOCK)
    later = F.floor((F.col("place") + template.context) / BLOCK)  # the last turns of a block are context of the next ones
    dealt = placed.select("conv_id", "place", "role", "text", block.alias("_own"), F.explode(F.sequence(block, later)).alias("block"))
    dealt = dealt.withColumn("own", F.col("block") == F.col("_own")).repartition(n, "conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    blocks = dealt.select("conv_id", "block", "place", "own", "role", "text").mapInArrow(_render_blocks(template), SCHEMA)
    return short(rows.join(few, same, "left_anti")).unionByName(blocks)


def formatted(pieces: DataFrame) -> DataFrame:
    """(conv_id, formatted) of conversations short enough to be one text each."""
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("p"))
    return whole.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"))


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"


def digests(pieces: DataFrame, template: Template = BRACKETS, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row a conversation, read back from its formatted pieces: digests of its turns and of what the loss mask covers.

    A digest takes a conversation's pieces one after another as they are sorted, holding one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c.split()[0]: [] for c in DIGEST.split(", ")}
        rows = _rows(batches, ["conv_id", "piece", "text_start", "text_end", "rewrites"])
        for conv_id, group in groupby(rows, key=lambda r: r[0]):
            all_turns, loss = hashlib.sha256(), hashlib.sha256()
            n = n_loss = chars = 0
            rewritten = False
            for _, piece, start, end, rewrites in group:
                read = template.read(piece)
                for role, text in read:
                    all_turns.update(f"{role}\n{text}\n".encode())
                if start is not None and read and read[0][0] in loss_roles:
                    text = template.unescape(piece[start:end])
                    loss.update(text.encode())
                    n_loss += len(text)
                n, chars, rewritten = n + len(read), chars + len(piece), rewritten or rewrites
            row = (conv_id, n, all_turns.hexdigest(), n_loss, loss.hexdigest(), chars, rewritten)
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        types = {"turns_sha256": pa.string(), "loss_sha256": pa.string(), "rewrites": pa.bool_()}
        yield pa.record_batch({c: pa.array(v, types.get(c, pa.int64())) for c, v in out.items()})

    n = partitions(pieces.sparkSession)
    return pieces.repartition(n, "conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "piece", "text_start", "text_end", "rewrites").mapInArrow(run, DIGEST)
