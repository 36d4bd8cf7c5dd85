"""Chat formatting at token level (operator 1).

A turn is START, the role, HEAD, the text, END.  The markers are ids reserved
above the vocabulary; role and text are encoded on their own, so no text can
yield a marker, and control strings inside texts are escaped reversibly, so the
rendered form cannot be misread either.  Masks come from prefix sums over a
whole batch: +1 where the text of a learned turn starts, -1 behind its end.

A formatted turn is a row, with its number and first token position within the
conversation; an unbounded conversation is never one row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from nextbuy.llm.ship import ship

#: Marker strings of the rendered form, in the order of their reserved ids.
MARKERS = ("<|turn|>", "<|text|>", "<|end|>")
#: Strings that other templates read as control, escaped too.
CONTROL = (*MARKERS, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
           "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>")
_CONTROL = re.compile("([<\\[])(\\\\*)(" + "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True)) + ")")
LEARNED = ("assistant",)


def escape(text: str) -> str:
    """One backslash more after the first character of every control string, escaped or not."""
    return _CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    """The exact inverse of ``escape``."""
    return _CONTROL.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def _tokenizer(path: str):
    from nextbuy.llm.token_counts import load_tokenizer

    tokenizer = load_tokenizer(path)
    tokenizer.encode_special_tokens = True
    return tokenizer, tokenizer.get_vocab_size(with_added_tokens=True)


def _encode(tokenizer, texts: list[str], first: int, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, mask, bounds of the turns) of turns given as role, text, role, text, ..."""
    parts = [np.array(x.ids, np.int32) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    n = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(n[0::2] + n[1::2] + len(MARKERS))
    starts = ends - (n[0::2] + n[1::2] + len(MARKERS))
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    body = starts + n[0::2] + 2
    for marker, at in enumerate((starts, body - 1, ends - 1)):
        ids[at] = first + marker
    for k, at in enumerate(np.stack([starts + 1, body], axis=1).ravel()):
        ids[at:at + n[k]] = parts[k]
    step = np.zeros(len(ids) + 1, np.int32)
    np.add.at(step, body[learned], 1)
    np.add.at(step, (ends - 1)[learned], -1)
    return ids, np.cumsum(step)[:-1].astype(np.int8), np.concatenate([[0], ends])


def format_turns(conversations: DataFrame, tokenizer_path: str, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """conv_id, turn, ids, mask of every row of ``conversations`` (conv_id, turn, role, text; others are ignored).

    Null texts and roles are empty.  Every row is formatted, repeated ones too;
    rows without conv_id form one conversation, rows without turn come first.
    """
    ship(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for batch in batches:
            if tokenizer is None:
                tokenizer, first = _tokenizer(tokenizer_path)
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            flat = [escape(x) for pair in zip(roles, texts, strict=True) for x in pair]
            ids, mask, bounds = _encode(tokenizer, flat, first, np.array([r in learned for r in roles], bool))
            offsets = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(mask))],
                names=["conv_id", "turn", "ids", "mask"])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, ids array<int>, mask array<tinyint>")


def place_turns(turns: DataFrame) -> DataFrame:
    """Adds ``number`` and ``first_token`` within the conversation (running counts in turn order; ties by ids)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "ids")
    return turns.withColumn("number", F.row_number().over(order)).withColumn(
        "first_token", F.coalesce(F.sum(F.size("ids")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


class _Digest:
    """Running digests of one conversation; a conversation of any length needs the same memory."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.learned, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.learned, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of the conversations, decoded from the formatted turns alone.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    Decoding is spread by turn.  A digest is a chain over the whole
    conversation, so its turns pass one task in order, one at a time.
    """
    ship(turns.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for batch in batches:
            if tokenizer is None:
                tokenizer, first = _tokenizer(tokenizer_path)
            texts, out = [], []
            for ids, mask in zip(batch.column(2), batch.column(3), strict=True):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                start, head, end = (int(np.flatnonzero(ids == first + k)[0]) for k in range(3))
                texts += [ids[start + 1:head].tolist(), ids[head + 1:end].tolist(), ids[(mask > 0) & (ids < first)].tolist()]
            plain = tokenizer.decode_batch(texts, skip_special_tokens=False)
            for k in range(0, len(plain), 3):
                out.append((unescape(plain[k]), unescape(plain[k + 1]), unescape(plain[k + 2]),
                            sum(map(len, MARKERS)) + len(plain[k]) + len(plain[k + 1])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x) for x in zip(*out, strict=True))] if out else
                                             [batch.column(0), batch.column(1), *(pa.array([], t) for t in (pa.string(),) * 3), pa.array([], pa.int64())],
                                             names=["conv_id", "turn", "role", "text", "loss", "chars"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        done: list[tuple] = []
        for batch in batches:
            for conv, _, role, text, loss, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv:
                    done += [now.row()] if now else []
                    now = _Digest(conv)
                now.turns += 1
                now.learned += len(loss)
                now.chars += chars
                now.all.update(f"{role}\n{text}\n".encode())
                now.loss.update(loss.encode())
            if len(done) >= 5000:
                yield _digests(done)
                done = []
        yield _digests(done + ([now.row()] if now else []))

    plain = turns.select("conv_id", "turn", "ids", "mask").mapInArrow(decode, "conv_id long, turn long, role string, text string, loss string, chars long")
    return plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)
