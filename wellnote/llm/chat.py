"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its reply
is trainable.  A formatted turn is ``<|im_start|>role\\ntext<|im_end|>\\n``; control strings inside
roles and texts are escaped reversibly, so the marks of the template stand only where it put them.

Examples are written out in full, so their size grows with a conversation's turns times its text: the
price of the method, whose context is every turn before the reply.  A task holds one conversation
and a few megabytes of finished examples.

Defined results: null text and null role count as empty; turns are ordered by (turn, role, text),
null turns first; rows with a null conv_id form one conversation; if turns stand behind the
last assistant turn, a last row without a target holds the whole conversation; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellnote.llm.common import batches_of, rows_of

START, END = "<|im_start|>", "<|im_end|>\n"
#: First characters of the control strings of common chat templates, which are
#: <|...|>, <s>, </s>, <<SYS>>, <</SYS>>, [INST] and [/INST].
_CONTROL = re.compile(r"\\|<(?=[|]|/?s>|</?SYS>>)|\[(?=/?INST\])")
_ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b", "\n": "\\n"}
_PLAIN = {v[1]: k for k, v in _ESCAPES.items()}
_ESCAPED = re.compile(r"\\(.)")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str, line: bool = False) -> str:
    """Escaped text without control strings; ``line``: without line breaks too."""
    out = _CONTROL.sub(lambda m: _ESCAPES[m[0]], text)
    return out.replace("\n", "\\n") if line else out


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


_SCHEMA = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("text", pa.large_string()),
                     ("loss_start", pa.int64()), ("loss_end", pa.int64())])
EXAMPLES = "conv_id long, example long, text string, loss_start long, loss_end long"


def format_examples(turns: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, example (from 0), text, loss_start, loss_end.

    ``text`` holds all turns up to and with the reply; only its code points [loss_start, loss_end),
    the reply, are trainable.  Both are null in the row of a conversation that ends without a reply.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def examples() -> Iterator[tuple]:
            conv, seen, number, context, parts = None, False, 0, "", []
            for conv_id, role, text in rows_of(batches):
                if not seen or conv_id != conv:
                    if parts:
                        yield conv, number, context + "".join(parts), None, None
                    conv, seen, number, context, parts = conv_id, True, 0, "", []
                body = escape(text)
                parts.append(f"{START}{escape(role, line=True)}\n{body}{END}")
                if role == "assistant":
                    context += "".join(parts)
                    end = len(context) - len(END)
                    yield conv, number, context, end - len(body), end
                    number, parts = number + 1, []
            if parts:
                yield conv, number, context + "".join(parts), None, None

        yield from batches_of(examples(), _SCHEMA)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
                        F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, EXAMPLES))


_READ = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("n_turns", pa.int64()),
                   ("turns_sha256", pa.string()), ("reply", pa.large_string()), ("chars", pa.int64())])
READ = "conv_id long, example long, n_turns long, turns_sha256 string, reply string, chars long"


def read_examples(examples: DataFrame) -> DataFrame:
    """Each example read on its own: its turns' number and digest, the text under its mask, its length.

    ``reply`` is unescaped, and null in a row without a target.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple]:
            for conv_id, example, text, start, end in rows_of(batches):
                digest, count = hashlib.sha256(), 0
                for turn in _TURN.finditer(text):
                    said = f"{unescape(turn[1])}\n{unescape(turn[2])}\n"
                    digest.update(said.encode("utf-8", "surrogatepass"))
                    count += 1
                reply = None if end is None else unescape(text[start:end])
                yield conv_id, example, count, digest.hexdigest(), reply, len(text)

        yield from batches_of(read(), _READ)

    return examples.select("conv_id", "example", "text", "loss_start", "loss_end").mapInArrow(run, READ)


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                      ("formatted_chars", pa.int64()), ("n_examples", pa.int64())])
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_examples long")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, read from the examples alone: turns, digests of turns and of trainable text.

    turns_sha256 covers role, line break, text, line break of each turn, as the conversation's longest
    row has them; loss_sha256 the unescaped text under the loss masks of its examples, in order;
    formatted_chars the code points of all its rows.  Only the replies are shuffled, and the digests
    run over them as a stream.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            conv, last, loss, loss_chars, chars, count = None, None, None, 0, 0, 0
            for conv_id, _, turns, digest, reply, length in rows_of(batches):
                if last is None or conv_id != conv:
                    if last is not None:
                        yield conv, *last, loss_chars, loss.hexdigest(), chars, count
                    conv, loss, loss_chars, chars, count = conv_id, hashlib.sha256(), 0, 0, 0
                last = turns, digest
                chars += length
                if reply is not None:
                    loss.update(reply.encode("utf-8", "surrogatepass"))
                    loss_chars, count = loss_chars + len(reply), count + 1
            if last is not None:
                yield conv, *last, loss_chars, loss.hexdigest(), chars, count

        yield from batches_of(digests(), _DIGESTS)

    return (read_examples(examples).repartition("conv_id").sortWithinPartitions("conv_id", "example")
            .mapInArrow(run, DIGESTS))
