"""Tokenizer files with word ends, and texts encoded through their white-space
chunks."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import spaced

# The normaliser's steps and the splitting pattern of the supported
# tokenizer files. They drop white space, never reach across it, and split
# letters from signs.
NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# End of fixed values.
SPLITTERS = [{"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
             {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
OTHER = ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "unk_token")


def load(path: str):
    """(content of a tokenizer file, the library's tokenizer); a file whose
    normaliser, splitter, decoder or model works otherwise is refused."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    m = spec["model"]
    if m["type"] != "BPE" or not m.get("end_of_word_suffix") or any(m.get(k) for k in OTHER) or spec.get("decoder") or spec.get("post_processor") \
            or (spec.get("normalizer") or {}).get("normalizers") != NORMALISERS or (spec.get("pre_tokenizer") or {}).get("pretokenizers") != SPLITTERS:
        raise ValueError("only BPE files with word ends, lower case and no decoder are supported")
    return spec, Tokenizer.from_file(path)


# Letters whose lower case and composed form are single letters in every Unicode
# version, and signs that no later sign joins: Latin (without the dotted capital
# I), Greek and Cyrillic.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481]+"
LETTERS_AND_SIGN = f"^({LETTERS})([.,;:!?])$"
PLAIN_LETTERS = re.compile(LETTERS)


def chunk_ids(texts: pa.Array, held: Callable[[list[str]], list[bytes]], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, number of ids of each text) for a tokenizer
    that drops white space, never reaches across it, splits letters from signs
    and takes no heed of case. Arrow finds and numbers chunks, puts ASCII ones in
    lower case (which could make a special string of "<|...|>") and a sign after
    plain letters apart; `held` gives the ids of distinct results, of type `kind`."""
    rows = pc.split_pattern(spaced(texts, b"\n\t\r"), " ")
    words = rows.flatten().dictionary_encode()
    chunks = words.dictionary
    plain = pc.and_(pc.string_is_ascii(chunks), pc.invert(pc.match_substring(chunks, "<|")))
    chunks = pc.if_else(plain, pc.ascii_lower(chunks), chunks)
    pieces = pc.split_pattern(pc.replace_substring_regex(chunks, LETTERS_AND_SIGN, r"\1 \2"), " ")
    found = pieces.flatten().dictionary_encode()
    got = held(found.dictionary.to_numpy(zero_copy_only=False).tolist())
    flat = np.frombuffer(b"".join(got), kind)
    size = np.fromiter(map(len, got), np.int64, len(got)) // np.dtype(kind).itemsize
    return _gather(*_gather(flat, size, found, pieces), words, rows)


def _gather(flat: np.ndarray, size: np.ndarray, words: pa.DictionaryArray, rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Runs of `flat`, `size` long each, picked by the number of every word, and
    how many values the words of each row bring."""
    code = words.indices.to_numpy(zero_copy_only=False)
    n = size[code]
    end = np.cumsum(n)
    small = np.int32 if len(flat) + (end[-1] if len(end) else 0) < 1 << 31 else np.int64
    at = (np.cumsum(size) - size)[code] - (end - n)
    out = flat[np.repeat(at.astype(small), n) + np.arange(end[-1] if len(end) else 0, dtype=small)]
    ends = np.r_[0, end][np.cumsum(pc.list_value_length(rows).to_numpy(zero_copy_only=False))]
    return out, np.diff(np.r_[0, ends])
