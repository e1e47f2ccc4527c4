"""Token counts by a whole-token shortcut.

A byte-pair tokenizer cuts a text into pre-tokens and merges each by itself.
``prove_whole_tokens`` shows once, on the driver, which vocabulary strings the
library encodes alone as one token; these pre-tokens count one without any merge.
Only the rest is merged, a pre-token at a time, and kept in a bounded cache per worker.

Edge cases: a null or empty text has 0 bytes and 0 tokens. The text of an added
token (such as an end-of-text marker) counts as that token wherever it stands, as
the library does by default. Repeated rows give repeated rows; very long texts are
counted whole; an empty table gives none. Other columns of the input are neither read nor kept, whatever their names.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm.common import batch_of, lean

#: Fixed: the pre-token pattern of byte-level BPE vocabularies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Distinct merged pre-tokens that a worker keeps.
CACHE = 400_000

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def prove_whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that are one pre-token and that the library encodes as one token."""
    import regex

    tok, letters, pattern = _tokenizer(path), _byte_letters(), regex.compile(BYTE_LEVEL)
    added = {t.content for t in tok.get_added_tokens_decoder().values()}
    texts = []
    for word in tok.get_vocab(with_added_tokens=False):
        try:
            text = bytes(letters[c] for c in word).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if pattern.fullmatch(text) and pattern.findall(text) == [text] and text not in added:
            texts.append(text)
    found = tok.encode_batch(texts, add_special_tokens=False)
    return sorted(t for t, e in zip(texts, found, strict=True) if len(e.ids) == 1)


def can_shortcut(path: str) -> bool:
    """Whether the file is a plain byte-level BPE, so that pre-tokens merge independently."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
    return spec["model"]["type"] == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and plain


def byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary as bytes with ranks, for the merging of single pre-tokens."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters = _byte_letters()
    return {bytes(letters[c] for c in word): i for word, i in vocab.items() if all(c in letters for c in word)}


#: Letters, numbers and white space among the code points below 0x250; texts of these need no Unicode tables.
_LATIN, _NUMBERS, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"
_SIMPLE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LATIN}]+| ?[{_NUMBERS}]+| ?[^{_SPACE}{_LATIN}{_NUMBERS}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+").findall
_BEYOND = re.compile("[^\x00-\u024f]").search


@functools.lru_cache(maxsize=1 << 16)
def _settled(char: str) -> bool:
    """Whether every Unicode version puts the character in the same class (letter, number, space, other)."""
    old, new = unicodedata.ucd_3_2_0.category(char), unicodedata.category(char)
    return old == new and old != "Cn"


@functools.lru_cache(maxsize=2)
def counter(path: str, whole: frozenset[str] | None) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of texts; one is made per worker and file.

    The library itself counts files that are no plain byte-level BPE, and texts with
    characters that Unicode versions class differently.
    """
    tok = _tokenizer(path)
    if whole is None:
        return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    import regex
    import tiktoken

    added = sorted((t.content for t in tok.get_added_tokens_decoder().values()), key=len, reverse=True)
    cut = re.compile("|".join(map(re.escape, added))) if added else None
    any_script = regex.compile(BYTE_LEVEL).findall
    merge = tiktoken.Encoding("merge", pat_str=BYTE_LEVEL, mergeable_ranks=byte_ranks(path), special_tokens={})._encode_single_piece
    known = dict.fromkeys(whole, 1)  # whole tokens, then merged ones up to CACHE

    def count_part(part: str) -> int:
        if _BEYOND(part) is None:
            words = _SIMPLE(part)
        elif all(map(_settled, set(part))):
            words = any_script(part)
        else:
            return len(tok.encode(part, add_special_tokens=False).ids)
        counts = list(map(known.get, words))
        if None in counts:
            if len(known) > len(whole) + CACHE:
                known.clear()
                known.update(dict.fromkeys(whole, 1))
            for i, n in enumerate(counts):
                if n is None:
                    word = words[i]
                    if (n := known.get(word)) is None:
                        n = len(merge(word))
                        if len(word) <= 64:
                            known[word] = n
                    counts[i] = n
        return sum(counts)

    def count(texts: list[str]) -> list[int]:
        out = []
        for text in texts:
            parts = cut.split(text) if cut is not None and cut.search(text) else [text]
            out.append(len(parts) - 1 + sum(map(count_part, parts)))
        return out

    return count


def proven(spark: SparkSession, path: str) -> Broadcast:
    """The whole tokens of a file on all tasks, at most its vocabulary; None where the library must count."""
    return spark.sparkContext.broadcast(frozenset(prove_whole_tokens(path)) if can_shortcut(path) else None)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than limit tokens) of every row."""
    whole = proven(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, whole.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield batch_of(SCHEMA, batch.column(0).to_pylist(), [len(t.encode()) for t in texts], count(texts))

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(lean(run), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
