"""Token ids of whole texts with a public tokenizer, and their pieces.

The tokenizer's own library is the measure.  Where its file describes a plain
byte-level vocabulary whose merges stand in the order of their ids, and every
merge's token comes apart into that merge when it is built from bytes by the
lowest id first, joining the pair of lowest id gives the same ids (what stands
beside a token's place can't change its inside before its borders are joined);
then texts are encoded that way, straight into an array, several times faster.
Texts that hold a special token's content or a piece of over ``PIECE`` bytes
without a break, and all texts of other tokenizers, go through the library.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 2048
PIECE = 512
END = b"\0\0\0\0"      # id 0, little-endian
# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
_LOADED: dict = {}


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _apart(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """``token`` built from bytes by pairs of lowest rank below its own, as far as that goes."""
    own, parts = ranks[token], [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        at = [ranks.get(a + b, own) for a, b in zip(parts, parts[1:])]
        low = min(at)
        if low >= own:
            break
        i = at.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def pair_ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes -> id, if joining the pair of lowest id is the tokenizer that ``spec`` (its file) describes."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and not any(spec.get(k) for k in ("normalizer", "truncation", "padding", "post_processor"))
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                "byte_fallback", "ignore_merges")))
    letters = _byte_letters()
    if not plain or any(c not in letters for t in model["vocab"] for c in t):
        return None
    ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
    pairs = [[bytes(letters[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    ids = [ranks.get(a + b, -1) for a, b in pairs]
    whole = all(bytes([b]) in ranks for b in range(256)) and len(ranks) == 256 + len(pairs)
    if not whole or ids != sorted(set(ids)) or any(_apart(a + b, ranks) != [a, b] for a, b in pairs):
        return None
    return ranks


class Encoder:
    """Text -> ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ranks = pair_ranks(spec)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.quick = tiktoken.Encoding("pairs", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None

    def whole(self, text: str) -> bytes:
        """By the tokenizer's own library."""
        e = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(e.ids, "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.quick or any(s in text for s in self.special) or _unbroken(text):
            return self.whole(text)
        return self.quick.encode_to_numpy(text).astype("<u4").tobytes()


def _unbroken(text: str) -> bool:
    """Does ``text`` hold over ``PIECE`` bytes without a space, or of nothing but white space?"""
    if len(text) <= PIECE // 4:
        return False
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return any(np.diff(np.flatnonzero(breaks), prepend=-1, append=len(b)).max(initial=0) > PIECE
               for breaks in (b == 32, ~_WHITE[b]))


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole ``length``s, the first one may be shorter."""
    head = n % length or min(n, length)
    return [(0, head)] + [(s, length) for s in range(head, n, length)]


def pieces(docs: DataFrame, path: str, text: str = "text", length: int = LENGTH, ids: str | None = None) -> DataFrame:
    """One row per piece: uid (of the row), doc_id, piece, start, length, ids_crc32; with ``ids`` ("<u2" or "<u4")
    also the ids in that type.  Null text counts as empty; every text ends with id 0."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        encode, uid = encoder(path), TaskContext.get().partitionId() << 40
        for b in batches:
            rows, held = [], 0
            for doc_id, t in zip(b["doc_id"].tolist(), b["t"]):
                x = encode(t) + END
                for k, (start, n) in enumerate(cuts(len(x) // 4, length)):
                    part = x[4 * start:4 * (start + n)]
                    row = (uid, None if pd.isna(doc_id) else int(doc_id), k, start, n, zlib.crc32(part))
                    rows.append(row + (np.frombuffer(part, "<u4").astype(ids).tobytes(),) if ids else row)
                    held += n
                uid += 1
                if ids and held > 1 << 21:
                    yield _frame(rows, bool(ids))
                    rows, held = [], 0
            yield _frame(rows, bool(ids))

    schema = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("t")).mapInPandas(run, schema)


def _frame(rows: list, ids: bool) -> pd.DataFrame:
    names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
