"""Token counts of whole texts, with overlap resynchronisation for huge ones (operator 3).

A text beyond ``CHUNK`` bytes is encoded in overlapping chunks with offsets.
Two neighbouring chunks are spliced at a position where both have a pre-token
boundary and that lies further from the left chunk's end than the tokenizer
ever looks ahead: from there on both see the same input in the same state, so
every later token is the same.  Without such a position the left chunk is
encoded again with an overlap twice as wide, up to the text's end.

Other texts are encoded whole.  Where the vocabulary is also given as ranks,
texts of plain Latin characters take the faster rank encoder, which yields the
same tokens there: its pattern and merges are the same, and both libraries
class these characters alike.  All other texts take the tokenizer itself.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nextbuy.llm.ship import ship
from nextbuy.llm.words import text_bytes

#: Bytes beyond which a text is encoded in chunks of as many characters; characters of an overlap.
CHUNK, OVERLAP = 32_768, 512
LIMIT = 512

_PLAIN = np.zeros(256, bool)  # bytes of line feed, U+0020 to U+007E and U+00C0 to U+017F
_PLAIN[[0x0A, *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = True


def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def look_ahead(tokenizer) -> int:
    """Characters behind a boundary that can still move it: the longest special string, and a few for the pattern."""
    return max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=0) + 8


def boundaries(encoding, tokens: range, until: Callable[[int], bool]) -> list[tuple[int, int]]:
    """(start, tokens before) of the pre-tokens at ``tokens``, up to the first start that ``until`` holds for.

    Special strings are pre-tokens of their own.  Offsets may leave out a
    leading space, so a start is taken from the end of the token before.
    """
    out = []
    for k in tokens:
        start = encoding.token_to_chars(k - 1)[1]
        if until(start):
            break
        word = encoding.token_to_word(k)
        if word is None or word != encoding.token_to_word(k - 1):
            out.append((start, k))
    return out


def count_huge(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, by overlapping chunks that are spliced at stable common boundaries."""
    margin = look_ahead(tokenizer)
    encode = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False)
    total, start, skip = 0, 0, 0  # ``skip`` tokens of the chunk at ``start`` are counted already
    end = min(chunk, len(text))
    left = encode(start, end)
    while end < len(text):
        wide, joined = overlap, None
        while joined is None:
            after = max(end - wide, start)
            last = min(after + chunk + wide, len(text))
            right = encode(after, last)
            behind = boundaries(left, range(len(left) - 1, max(skip, 1) - 1, -1), lambda p: p + start < after)
            stable = {p + start: k for p, k in behind if p + start <= end - margin}
            ahead = boundaries(right, range(1, len(right)), lambda p: p + after > end - margin)
            joined = next(((stable[p + after], k) for p, k in ahead if p + after in stable), None)
            if joined is None:  # widen: the left chunk reaches further, and so does the overlap
                wide *= 2
                end = min(end + wide, len(text))
                left = encode(start, end)
                if end == len(text):
                    return total + len(left) - skip
        total += joined[0] - skip
        start, skip, end, left = after, joined[1], last, right
    return total + len(left) - skip


class Counter:
    """Counts whole texts of Arrow columns."""

    def __init__(self, path: str, ranks_path: str | None = None):
        self.tokenizer, self.ranks = load_tokenizer(path), None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, tokens) of each text; null counts as empty."""
        data, offsets = text_bytes(column)
        size = np.diff(offsets)
        tokens = np.zeros(len(size), np.int64)
        others = []
        for d in np.flatnonzero(size):
            part = data[offsets[d]:offsets[d + 1]]
            text = part.tobytes().decode()
            if size[d] > CHUNK:
                tokens[d] = count_huge(text, self.tokenizer)
            elif self.ranks and _PLAIN[part].all() and not any(x in text for x in self.special):
                tokens[d] = len(self.ranks.encode_ordinary(text))
            else:
                others.append((d, text))
        for k in range(0, len(others), 200):
            some = others[k:k + 200]
            tokens[[d for d, _ in some]] = [len(x) for x in self.tokenizer.encode_batch_fast([t for _, t in some], add_special_tokens=False)]
        return size, tokens


def count_tokens(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text; other columns are ignored).

    Null and empty texts have 0 bytes and tokens.  Every row is counted, rows
    that repeat an id or have none too; an empty table gives an empty result.
    The files must exist on every executor.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(tokenizer_path, ranks_path)
            size, tokens = counter.column(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
