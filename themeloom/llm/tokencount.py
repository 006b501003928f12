"""Token counts of whole texts; huge ones by overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import small_batches
from themeloom.llm.tokens import library

#: Characters from which a text is encoded by chunks, and the overlap tried first.
CHUNK, OVERLAP = 32_768, 256
#: Words whose counts a worker remembers; it starts afresh beyond.
REMEMBERED = 300_000
#: Separators of str.split that the tokenizer takes for symbols.
_ODD = re.compile("[\x1c-\x1f]")
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_SPACE = " \t\n\r\x0b\x0c"

#: Texts by which a tokenizer's treatment of white space is told.
_PROBES = ["ab cd", "a  b\tc\nd\r\x0b\x0ce", " x9 12 3.4 !? it's ", "\n\n  é ü\t日本 語"]

Encode = Callable[[str], list[tuple[int, int]]]


def words(text: str) -> list[str]:
    """Parts of a text between white space, where no token of this vocabulary can cross."""
    return _WORD.findall(text) if _ODD.search(text) else text.split()


def boundaries(tokenizer) -> str:
    """How a tokenizer treats ASCII white space: `dropped`, `leads` (only at the front of a piece), or `unknown`.

    Where it is dropped no token crosses it and counts add up over words; where it leads, texts can be spliced at it.
    """
    added = tokenizer.get_added_tokens_decoder().values()
    if tokenizer.pre_tokenizer is None or any(re.search(r"\s", t.content) or t.lstrip or t.rstrip for t in added):
        return "unknown"
    pieces = [tokenizer.pre_tokenizer.pre_tokenize_str(p) for p in _PROBES]
    inside = [p[a:b] for p, held in zip(_PROBES, pieces, strict=True) for _, (a, b) in held]
    if all(not re.search(f"[{_SPACE}]", x) for x in inside):
        return "dropped"
    return "leads" if all(re.fullmatch(f"[{_SPACE}]*[^{_SPACE}]*", x) for x in inside) else "unknown"


def splice_count(text: str, encode: Encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text from overlapping chunks. encode gives the (start, end) of each token of a string.

    Two neighbouring chunks are spliced at a place in their overlap where a token starts in both and white
    space stands before it: no token, normalisation or special string reaches across, so both encodings
    are those of the whole text there. Without such a place the overlap is doubled, then the chunk.
    """
    n, at, total = len(text), 0, 0
    held = encode(text[:chunk])
    end = min(n, chunk)
    while end < n:
        width, found = overlap, None
        starts = {at + s for s, e in held if e > s}
        while found is None:
            begin = max(at, end - width)
            if begin == at:  # nothing stable in this chunk: encode a longer one
                chunk *= 2
                end = min(n, at + chunk)
                held = encode(text[at:end])
                break
            other_end = min(n, begin + chunk)
            other = encode(text[begin:other_end])
            common = [begin + s for s, e in other if e > s and 0 < s < end - begin]
            found = next((o for o in reversed(common) if o in starts and text[o - 1] in _SPACE), None)
            width *= 2
        if found is not None:
            total += sum(at + s < found for s, _ in held)
            held = [(begin + s - found, begin + e - found) for s, e in other if begin + s >= found]
            at, end = found, other_end
    return total + len(held)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs, whole texts, no added tokens.

    `path` is a vocabulary file of the tokenizers library. Texts over CHUNK characters are spliced from chunks. Shorter
    ones are encoded whole, or, where the tokenizer drops white space, are sums over their words, each encoded once for a
    worker. A tokenizer whose pieces may cross white space (see boundaries) encodes every text whole. Null and empty texts
    have 0 bytes and tokens; repeated rows are counted each; a null doc_id stays null; other columns are left alone.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library(path)
        space = boundaries(tokenizer)
        known: dict[str, int] = {}

        def offsets(x: str) -> list[tuple[int, int]]:
            return tokenizer.encode(x, add_special_tokens=False).offsets

        def count(x: str, ws: list[str] | None) -> int:
            if ws is not None:
                return sum(map(known.__getitem__, ws))
            return len(offsets(x)) if space == "unknown" or len(x) <= CHUNK else splice_count(x, offsets)

        for batch in batches:
            ids, texts = batch.column(0), [x or "" for x in batch.column(1).to_pylist()]
            split = [words(x) if space == "dropped" and len(x) <= CHUNK else None for x in texts]
            if len(known) > REMEMBERED:
                known.clear()
            new = list({w for ws in split if ws for w in ws if w not in known})
            for at in range(0, len(new), 20_000):
                part = new[at : at + 20_000]
                known.update(zip(part, map(len, tokenizer.encode_batch_fast(part, add_special_tokens=False)), strict=True))
            counts = [count(x, ws) for x, ws in zip(texts, split, strict=True)]
            n = [len(x.encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    out = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = out.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
