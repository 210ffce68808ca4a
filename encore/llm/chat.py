"""Chat formatting by incremental black-box rendering.

A template is any function from a list of messages to a string; nothing is
known of its inside. A conversation is rendered prefix by prefix: the text that
turn k adds to the output of turns 0..k-1 is the turn's span. Where an output
does not start with the one before it, the template has rewritten history;
those turns are reported, and the spans are then located in the final output.
A turn's content is located by rendering the turn once more with a marker text
in place of its own.

The rows of a conversation meet in one task, as one training example; nothing
else does.

Defined cases: rows are ordered by turn, then role, then text, nulls first;
repeated rows are repeated turns; null text and null role are empty; rows
without a conversation id form one conversation (id null); an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import sha256_hex

Message = dict[str, str]
Template = Callable[[list[Message]], str]

START, END = "<|im_start|>", "<|im_end|>"
SPAN = "struct<turn:int,role:string,start:long,end:long,content_start:long,content_end:long,loss:boolean>"
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Reversible: the result holds no ``<|``, so no control string."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def chatml(messages: list[Message]) -> str:
    """The default template: a line with the role, the escaped text, an end mark."""
    return "".join(f"{START}{escape(m['role']).replace(chr(10), chr(92) + 'n')}\n{escape(m['text'])}{END}\n" for m in messages)


def parse_chatml(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from the default template's output."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def marker_for(messages: list[Message], output: str) -> str:
    """A text that neither the messages nor their output hold: private-use characters around a word and a number."""
    said, n = [output, *(x for m in messages for x in m.values())], 0
    while any(f"\ue000marker{n}\ue001" in x for x in said):
        n += 1
    return f"\ue000marker{n}\ue001"


def _content(template: Template, messages: list[Message], k: int, output: str, begin: int, marker: str) -> tuple[int, int]:
    """Where turn k's text lies in ``output``; (-1, -1) if it can't be told.

    The probe has the marker in place of the text. What stands before and after
    the marker must stand before and after the text in the output.
    """
    probe = template([*messages[:k], {**messages[k], "text": marker}, *messages[k + 1:]])
    at = probe.find(marker, begin)
    tail = len(probe) - at - len(marker)
    end = len(output) - tail
    if at < 0 or end < at or output[:at] != probe[:at] or output[end:] != probe[at + len(marker):]:
        return -1, -1
    return at, end


def render(messages: list[Message], template: Template = chatml, loss_roles: Iterable[str] = ("assistant",)):
    """(final output, spans, turns at which history was rewritten).

    A span is (turn, role, start, end, content_start, content_end, loss), in code
    points of the final output, ends exclusive; -1 where the final output
    doesn't show it.
    """
    before, spans, rewrites = template([]), [], []
    marker = marker_for(messages, template(messages))
    for k in range(len(messages)):
        output = template(messages[:k + 1])
        begin = len(before)
        if output.startswith(before):
            start, end = _content(template, messages[:k + 1], k, output, begin, marker)
            spans.append((begin, len(output), start, end))
        else:
            rewrites.append(k)
            spans.append((-1, -1, -1, -1))
        before = output
    if rewrites:  # earlier spans no longer hold: look for every turn in the final output
        spans = []
        for k in range(len(messages)):
            start, end = _content(template, messages, k, before, 0, marker)
            spans.append((start, end, start, end))
    wanted = set(loss_roles)
    return before, [(k, m["role"], *s, m["role"] in wanted and s[2] >= 0) for k, (m, s) in enumerate(zip(messages, spans))], rewrites


def format_chats(conversations: DataFrame, template: Template = chatml, loss_roles: tuple[str, ...] = ("assistant",),
                 id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: conv_id, formatted, spans, rewrites."""
    id_type = dict(conversations.dtypes)[id_col]
    empty = F.lit("")
    turns = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), empty).alias("text"))
    grouped = (conversations.select(F.col(id_col).alias("conv_id"), turns.alias("m"))
               .groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
               .select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("m")))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, spans, rewrites = [], [], []
                for messages in part.column("m").to_pylist():
                    output, found, changed = render(messages, template, loss_roles)
                    texts.append(output)
                    spans.append([dict(zip(("turn", "role", "start", "end", "content_start", "content_end", "loss"), s)) for s in found])
                    rewrites.append(changed)
                struct = pa.struct([("turn", pa.int32()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                    ("content_start", pa.int64()), ("content_end", pa.int64()), ("loss", pa.bool_())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(texts, pa.string()), pa.array(spans, pa.list_(struct)), pa.array(rewrites, pa.list_(pa.int32()))],
                    names=["conv_id", "formatted", "spans", "rewrites"])

    return grouped.mapInArrow(run, f"conv_id {id_type}, formatted string, spans array<{SPAN}>, rewrites array<int>")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts and loss masks say, read back: one row a conversation."""
    id_type = dict(formatted.dtypes)["conv_id"]

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
                turns = parse_chatml(text)
                loss = "".join(unescape(text[s["content_start"]:s["content_end"]]) for s in spans if s["loss"])
                out.append((len(turns), sha256_hex("".join(f"{role}\n{said}\n" for role, said in turns)), len(loss), sha256_hex(loss), len(text)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "spans").mapInArrow(
        run, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
