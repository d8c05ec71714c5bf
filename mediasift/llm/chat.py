"""Chat formatting by incremental black-box rendering.

A template is a function from turns to text and is never looked into. Successive prefixes of a
conversation are rendered; what a turn adds to the output before it is the turn's span, and two probe
texts in the turn's place show where in the span its text stands. An output that does not begin with
the output before it comes from a template that rewrites history.

Conversations are streams: rows come sorted by turn, and a window of ``run`` turns is all that is held.
Longer conversations are rendered window by window, which is right for templates whose turns add the
same text after any history; that is tested with probes before the job (``adds_the_same_text``), and
other templates get whole conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.llm.common import arrow_schema, col
from mediasift.sources.tables import table

Turn = tuple[str, str]
RUN = 32
#: A conversation with more rows than this, and than a thousandth of all rows (so there are under 1,000
#: of them), is rendered by several tasks, ``BLOCK`` turn numbers each.
HOT_ROWS, BLOCK = 4096, 1024


class MarkedTemplate:
    """``### role: text </turn>`` lines. A backslash guards backslashes and control strings in texts, so
    reading back is exact."""

    local = True  # what a turn adds depends on nothing but the turn
    _GUARD = re.compile(r"\\|###|</turn>")
    _READ = re.compile(r"\\(\\|###|</turn>)")
    opening, closing = "### ", " </turn>\n"

    def escape(self, text: str) -> str:
        return self._GUARD.sub(lambda m: "\\" + m.group(), text)

    def unescape(self, text: str) -> str:
        return self._READ.sub(r"\1", text)

    def render(self, turns: list[Turn]) -> str:
        return "".join(f"{self.opening}{self.escape(r)}: {self.escape(t)}{self.closing}" for r, t in turns)

    def role_of(self, head: str) -> str:
        """The role from what a turn adds before its text."""
        return self.unescape(head[len(self.opening):-2])


def _same(a: str, b: str, start: int) -> int:
    """Length of the common prefix of two strings that agree up to ``start``."""
    n = min(len(a), len(b))
    while start < n and a[start] == b[start]:
        start += 1
    return start


def turn_span(render: Callable, history: list[Turn], before: str, turn: Turn) -> tuple[str, int, int, bool]:
    """(output with the turn, start and end of its text in it, whether earlier output changed)."""
    after = render([*history, turn])
    a, b = (render([*history, (turn[0], x)]) for x in "xy")
    kept = after.startswith(before)
    head = _same(a, b, len(before) if a.startswith(before) and b.startswith(before) else 0)
    if a == b:  # the template does not show this turn's text
        return after, len(after), len(after), not kept
    tail = _same(a[head + 1:][::-1], b[head + 1:][::-1], 0)
    return after, head, len(after) - tail, not kept


def conversation_spans(render: Callable, turns: list[Turn]) -> dict:
    """Output of a whole conversation, the (start, end) of each turn's text in it, and ``rewritten``: the
    first turn whose rendering changes earlier output (-1: none). With a template that rewrites history
    the spans are found in the final output, by probes in each turn's place."""
    out, spans, rewritten = render([]), [], -1
    for k, turn in enumerate(turns):
        out, lo, hi, changed = turn_span(render, turns[:k], out, turn)
        spans.append((lo, hi))
        if changed and rewritten < 0:
            rewritten = k
    if rewritten >= 0:
        spans = []
        for k, (role, _) in enumerate(turns):
            a, b = (render([*turns[:k], (role, x), *turns[k + 1:]]) for x in "xy")
            head = _same(a, b, 0)
            shown = a != b
            spans.append((head, len(out) - _same(a[head + 1:][::-1], b[head + 1:][::-1], 0)) if shown else (head, head))
    return {"output": out, "spans": spans, "rewritten": rewritten}


def adds_the_same_text(render: Callable) -> bool:
    """Whether, on probes, a turn adds the same text after any history that is not empty."""
    probes = [("system", "s"), ("user", "u"), ("assistant", "a"), ("user", ""), ("assistant", "<think>t</think> b"),
              ("tool", "x"), ("user", "v"), ("assistant", "c")]
    for k in range(1, len(probes)):
        for last in range(k + 1):
            whole, short = render(probes[:k]), render(probes[:1])
            a, b = render([*probes[:k], probes[last]]), render([*probes[:1], probes[last]])
            if not (a.startswith(whole) and b.startswith(short) and a[len(whole):] == b[len(short):]):
                return False
    return True


def is_local(template) -> bool:
    """Whether the class (or object) that defines ``render`` declares itself ``local``, and the probes agree.
    Probes alone can't tell: what they don't hold, a long history say, may change the output."""
    owner = next(o for o in (template, *type(template).__mro__) if "render" in getattr(o, "__dict__", ()))
    return bool(vars(owner).get("local")) and adds_the_same_text(template.render)


def _windows(template, turns: Iterator[Turn], run: int | None, first: bool) -> Iterator[tuple[str, list]]:
    """(text added, [(role, text, start and end of the text in it, rewritten)]) for each window of turns."""
    start: list[Turn] = [] if first else [("user", "")]
    while True:
        history, base = list(start), template.render(start)
        out, found, spans = base, [], []
        for role, text in turns:
            out, lo, hi, changed = turn_span(template.render, history, out, (role, text))
            history.append((role, text))
            spans.append((lo, hi, changed))
            if run and len(spans) == run:
                break
        if not spans:
            return
        if any(c for *_, c in spans):
            whole = conversation_spans(template.render, history)
            out, spans = whole["output"], [(a, b, whole["rewritten"] >= 0) for a, b in whole["spans"]]
        end = len(base)
        for lo, hi, changed in spans:
            found.append((template.role_of(out[end:lo]), out[lo:hi], lo - len(base), hi - len(base), changed))
            end = hi + len(template.closing)
        yield out[len(base):], found
        if run is None or len(spans) < run:
            return
        start = [("user", "")]


_PIECES = "conv string, block long, part long, formatted string, roles array<string>, starts array<int>, " \
          "ends array<int>, rewritten boolean"


def _runs(batches, same: Callable) -> Iterator[tuple[tuple, Iterator]]:
    """Rows of sorted batches as (key, rows) of one key after another; rows must be used up in turn."""
    rows = ((same(r), r) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    ahead = next(rows, None)
    while ahead is not None:
        key = ahead[0]

        def of_key():
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                row = ahead[1]
                ahead = next(rows, None)
                yield row

        own = of_key()
        yield key, own
        for _ in own:
            pass


def _prepare(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return df.select(col(conv).cast("string").alias("conv"), F.coalesce(
        F.floor(col(turn) / BLOCK).cast("long"), F.lit(-(1 << 62))).alias("block"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))


def format_conversations(df: DataFrame, template=None, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", run: int = RUN) -> DataFrame:
    """Rows (conv, block, part, formatted, roles, starts, ends, rewritten): the formatted text of every
    conversation in pieces of up to ``run`` turns, in order of (block, part), with the offsets of each
    turn's (escaped) text in its piece.

    Turns go by number, null numbers first, ties by role and text; null role and text are empty; a null
    conversation id is a conversation of its own; repeated rows are repeated turns. Other columns are
    ignored. One shuffle by (conversation, block); tasks hold ``run`` turns. A template that isn't declared ``local``
    gets whole conversations (held by one task each) and says in ``rewritten`` if it changed earlier output.
    """
    template = template or MarkedTemplate()
    local = is_local(template)
    rows = _prepare(df, conv, turn, role, text)
    if not local:
        rows = rows.withColumn("block", F.lit(0).cast("long"))
    if local:  # only a conversation's first block starts it
        low = rows.groupBy(F.col("conv").alias("_conv")).agg(F.min("block").alias("_low"))
        rows = rows.join(low, F.col("conv").eqNullSafe(F.col("_conv"))).select(
            "conv", "block", "turn", "role", "text", (F.col("block") == F.col("_low")).alias("first"))
    else:
        rows = rows.withColumn("first", F.lit(True))
    ordered = rows.repartition("conv", "block").sortWithinPartitions("conv", "block", "turn", "role", "text")

    schema = arrow_schema(_PIECES)

    def work(batches):
        for (name, block, is_first), own in _runs(batches, lambda r: (r[0], r[1], r[5])):
            pieces = _windows(template, ((r[3], r[4]) for r in own), run if local else None, is_first)
            for part, (out, found) in enumerate(pieces):
                yield pa.RecordBatch.from_pylist([{
                    "conv": name, "block": block, "part": part, "formatted": out, "roles": [f[0] for f in found],
                    "starts": [f[2] for f in found], "ends": [f[3] for f in found],
                    "rewritten": any(f[4] for f in found)}], schema=schema)

    return ordered.mapInArrow(work, _PIECES)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, template, formatted: str, found: list, loss_roles) -> None:
        self.chars += len(formatted)
        for role, escaped, *_ in found:
            text = template.unescape(escaped)
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role in loss_roles:
                self.loss.update(text.encode("utf-8", "surrogatepass"))
                self.loss_chars += len(text)

    def row(self, conv) -> list:
        return [conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars]


_DIGESTS = "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _emit(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


def conversation_digests(df: DataFrame, template=None, loss_roles=("assistant",), conv: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, read back from the formatted output: number of turns, digest of the turns,
    characters and digest of the text under the loss mask, length of the output. Rules as above.

    Rows are shuffled once by conversation and streamed. Conversations that hold a large part of all rows
    are formatted in blocks by several tasks first; only their digest, which is sequential, is one stream.
    """
    template = template or MarkedTemplate()
    local = is_local(template)
    counts = df.groupBy(col(conv).cast("string").alias("conv")).count()
    total = df.count()
    hot = [r.conv for r in counts.filter(F.col("count") > max(HOT_ROWS, total // 1000)).select("conv").collect()]
    rows, schema = _prepare(df, conv, turn, role, text), arrow_schema(_DIGESTS)
    is_hot = F.lit(False)
    if hot:
        is_hot = F.coalesce(F.col("conv").isin([h for h in hot if h is not None]), F.lit(None in hot))

    def whole(batches):
        out = []
        for name, own in _runs(batches, lambda r: r[0]):
            digest = _Digest()
            for formatted, found in _windows(template, ((r[2], r[3]) for r in own), RUN if local else None, True):
                digest.add(template, formatted, found, loss_roles)
            out.append(digest.row(name))
            if len(out) == 4096:
                yield _emit(out, schema)
                out = []
        if out:
            yield _emit(out, schema)

    ordered = rows.filter(~is_hot).select("conv", "turn", "role", "text").repartition("conv").sortWithinPartitions(
        "conv", "turn", "role", "text")
    done = ordered.mapInArrow(whole, _DIGESTS)
    if not hot:
        return done

    def join(batches):
        for name, own in _runs(batches, lambda r: r[0]):
            digest = _Digest()
            for _, _, _, formatted, roles, starts, ends, _ in own:
                digest.add(template, formatted, [(r, formatted[a:b]) for r, a, b in zip(roles, starts, ends, strict=True)],
                           loss_roles)
            yield _emit([digest.row(name)], schema)

    pieces = format_conversations(rows.filter(is_hot), template, "conv", "turn", "role", "text")
    return done.unionByName(pieces.repartition("conv").sortWithinPartitions("conv", "block", "part").mapInArrow(
        join, _DIGESTS))


def op4_chat(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return conversation_digests(rows).select(F.col("conv").cast("long").alias("conv_id"), "n_turns", "turns_sha256",
                                             "loss_chars", "loss_sha256", "formatted_chars")


QUERIES = {"op4_chat": op4_chat}

_ESCAPED = r"regexp_replace({}, '(\\|###|</turn>)', '\\\1', 'g')"
ORACLE = {"op4_chat": r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(ESC(role)) + length(ESC(text)) + 15) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id""".replace("ESC(role)", _ESCAPED.format("role")).replace("ESC(text)", _ESCAPED.format("text"))}
