"""Chat formatting by incremental black-box rendering (operator 5).

A template is any function from a list of (role, text) turns to a string. The
formatter renders successive prefixes of a conversation and compares consecutive
outputs: where each output starts with the one before, the rest is the span of
the new turn; where it does not, the template rewrites history. The place of the
text inside its span is found by rendering the turn once more with a probe text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.common import map_arrow, store

Turn = tuple[str | None, str]
Template = Callable[[list[Turn]], str]

PROBE = "probe"
#: Control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[TURN]", "[/TURN]")
_FORGED = re.compile(r"([<\[])(\\*)(/?(?:s>|(?:INST|SYS|TURN)\]))")
_GUARDED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|(?:INST|SYS|TURN)\]))")


def escape(text: str) -> str:
    """Adds a backslash after the bracket of every control string, escaped ones included."""
    return _FORGED.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _GUARDED.sub(r"\1\2\3", text)


def inst_template(turns: list[Turn]) -> str:
    """<s>, then each turn: [SYS] text [/SYS], [INST] text [/INST], an assistant's text</s>, or any other role by name."""
    out = ["<s>"]
    for role, text in turns:
        body = escape(text)
        if role == "user":
            out.append(f"[INST] {body} [/INST]")
        elif role == "assistant":
            out.append(f" {body}</s>")
        elif role == "system":
            out.append(f"[SYS] {body} [/SYS]")
        else:
            out.append(f"[TURN] {escape(json.dumps(role))} {body} [/TURN]")
    return "".join(out)


def parse_span(span: str) -> Turn:
    """The turn that ``inst_template`` wrote as ``span``."""
    span = span.removeprefix("<s>")
    for role, opening, closing in (("user", "[INST] ", " [/INST]"), ("system", "[SYS] ", " [/SYS]"), ("assistant", " ", "</s>")):
        if span.startswith(opening):
            return role, unescape(span[len(opening) : -len(closing)])
    inner = span.removeprefix("[TURN] ").removesuffix(" [/TURN]")
    name, end = json.JSONDecoder().raw_decode(inner)
    name = unescape(inner[:end]) if isinstance(name, str) else inner[:end]
    return json.loads(name), unescape(inner[end + 1 :])


def next_span(template: Template, turns: list[Turn], before: str) -> tuple[str, tuple[str | None, int, int]]:
    """The rendering of ``turns``, and what the last of them adds to that of the others, ``before``: see ``spans``."""
    now, role = template(list(turns)), turns[-1][0]
    if not now.startswith(before):
        return now, (None, 0, 0)
    span = now[len(before) :]
    probe = template([*turns[:-1], (role, PROBE)])
    at = probe.find(PROBE, len(before)) if probe.startswith(before) else -1
    if at < 0:
        return now, (span, 0, 0)
    tail = len(probe) - at - len(PROBE)
    return now, (span, at - len(before), len(span) - tail)


def spans(template: Template, turns: list[Turn]) -> list[tuple[str | None, int, int]]:
    """For each turn: the text it adds to the rendered prefix (None if earlier output changed), and where its content lies in it."""
    out, before = [], ""
    for n in range(1, len(turns) + 1):
        before, found = next_span(template, turns[:n], before)
        out.append(found)
    return out


_FORMATTED = "conv_id long, position long, role string, span string, content_from int, content_to int, rewrites boolean"


def _format(template: Template, window: int | None):
    """Rows sorted by conversation and turn; the turns of one conversation (or of a window) and the last rendering are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "position", "role", "span", "content_from", "content_to", "rewrites"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
        conv, position, turns, before, started = None, 0, [], "", False
        for batch in batches:
            out = []
            for c, role, text in zip(*[batch.column(k).to_pylist() for k in ("conv_id", "role", "text")], strict=True):
                if not started or c != conv:
                    conv, position, turns, before, started = c, 0, [], "", True
                elif window is not None and len(turns) > window:
                    turns = turns[-1:]
                    before = template(list(turns))
                turns.append((role, text or ""))
                before, (span, a, b) = next_span(template, turns, before)
                out.append((conv, position, role, span, a, b, span is None))
                position += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def format_conversations(turns: DataFrame, template: Template = inst_template, window: int | None = None) -> DataFrame:
    """Format ``turns`` (conv_id, turn, role, text) by ``template``.

    Returns one row per turn: conv_id, position (0, 1, ... by turn; ties by role
    and text, null turns first), role, span (the turn's part of the formatted
    conversation, which is the spans one after the other), content_from and
    content_to (the text's place in its span, in code points), and rewrites: the
    output before the turn changed when it came, so it has no span of its own.
    Null texts are empty; rows without a conv_id are one conversation; repeated
    rows are separate turns. Every turn is rendered after all turns before it, so
    the work grows with the square of a conversation's turns. With ``window``,
    at most that many turns and one before are rendered together: only for
    templates that are stateless, where a turn's output does not depend on other
    turns, but for what comes before the first. Other columns are not read.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return map_arrow(rows, _format(template, window), _FORMATTED)


def _digest(parse: Callable[[str], Turn]):
    """Rows sorted by conversation and turn; only the digests so far are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        conv, started, n, chars, size, all_turns, loss = None, False, 0, 0, 0, hashlib.sha256(), hashlib.sha256()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            out = []
            for c, span, a, b in zip(*[batch.column(k).to_pylist() for k in ("conv_id", "span", "content_from", "content_to")], strict=True):
                if started and c != conv:
                    out.append((conv, n, all_turns.hexdigest(), chars, loss.hexdigest(), size))
                    n, chars, size, all_turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                conv, started = c, True
                role, text = parse(span)
                all_turns.update(f"{role or ''}\n{text}\n".encode())
                n, size = n + 1, size + len(span)
                if role == "assistant":
                    masked = unescape(span[a:b])
                    loss.update(masked.encode())
                    chars += len(masked)
            if out:
                yield batch_of(out)
        if started:
            yield batch_of([(conv, n, all_turns.hexdigest(), chars, loss.hexdigest(), size)])

    return run


def conversation_digests(turns: DataFrame, template: Template = inst_template, parse: Callable[[str], Turn] = parse_span) -> DataFrame:
    """Format ``turns``, write the result, and read it back: one row per conversation.

    ``template`` escapes control strings as ``escape`` does and rewrites no history;
    ``parse`` gives the turn that it wrote as a span.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn, parsed
    from the formatted text; a null role is empty), loss_chars and loss_sha256 (the
    unescaped text under the loss mask: the content of assistant turns),
    formatted_chars. Every turn is rendered after all turns before it, however many.
    """
    formatted = store(format_conversations(turns, template), "formatted")
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position").select("conv_id", "span", "content_from", "content_to")
    return map_arrow(rows, _digest(parse), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
