"""Token ids of texts, with the vocabulary's whole tokens found without merging.

Where no pre-token and no special string holds white space and the normalizer doesn't join characters across it, a text's tokens are those of its white-space separated words one
after the other, and each distinct word of a batch is encoded once. ``word_wise`` reads from the tokenizer file whether that is so; texts of any other tokenizer go to the library whole.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from locusmill.llm.words import ragged, word_codes

#: Words of these characters only are split here; NFC leaves them alone and lower case maps each to one of them.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# The tokenizer's split pattern, on lower-case words of the characters above.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Starts every special string; words that hold it go to the library whole.
_SPECIAL = "<|"
#: Pre-tokens that a worker remembers.
REMEMBERED = 100_000


@lru_cache(maxsize=2)
def loaded(spec: str) -> Tokenizer:
    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    return t


#: What a tokenizer file must say for its texts to be encoded word by word, by the patterns above.
WORD_WISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


@lru_cache(maxsize=2)
def word_wise(spec: str) -> bool:
    """Whether texts are encoded word by word: the file's normalizer, split and end of word are those that ``encode_words`` knows, and its special strings start as known and hold no white space."""
    file = json.loads(spec)
    special = [t["content"] for t in file.get("added_tokens") or []]
    plain = file.get("post_processor") is None and file["model"].get("end_of_word_suffix") == "</w>" and file["model"]["type"] == "BPE"
    return plain and all(file.get(k) == v for k, v in WORD_WISE.items()) and all(t.startswith(_SPECIAL) and t.split() == [t] for t in special)


def encode(texts: pa.Array, spec: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token ids of units, the units' offsets into them, the units of all texts, the texts' offsets into those.

    Units are words, each distinct one encoded once, or whole texts. Null texts have no ids.
    """
    if word_wise(spec):
        w = word_codes(texts)
        ids, at = encode_words(w.names, spec)
        return ids, at, w.codes, w.offsets
    got = loaded(spec).encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
    per = np.array([len(e.ids) for e in got], np.int64)
    ids = np.fromiter((i for e in got for i in e.ids), np.uint32, int(per.sum()))
    return ids, np.concatenate([[0], np.cumsum(per)]), np.arange(len(got)), np.arange(len(got) + 1)


@lru_cache(maxsize=2)
def whole_tokens(spec: str) -> dict[str, int]:
    """Strings that are one pre-token and encode alone as one token: each is proved by the library itself."""
    t = loaded(spec)
    names = sorted({s for i in range(t.get_vocab_size()) if (s := _string(t.id_to_token(i))) and _PLAIN.fullmatch(s) and _SPECIAL not in s and s == s.lower() and _SPLIT.fullmatch(s)})
    got = t.encode_batch_fast(names, add_special_tokens=False)
    return {s: e.ids[0] for s, e in zip(names, got) if len(e.ids) == 1}


def _string(token: str) -> str:
    """The string that a token ending a word stands for; empty if there is none."""
    if not token.endswith("</w>"):
        return ""
    try:
        return bytes(_BYTE[c] for c in token[:-4]).decode()
    except (KeyError, UnicodeDecodeError):
        return ""


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


_BYTE = _byte_letters()
#: The byte letters of the characters of ``_PLAIN`` beyond ASCII.
_LETTERS = {c: "".join({b: x for x, b in _BYTE.items()}[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


@lru_cache(maxsize=2)
def _remembered(spec: str) -> dict[str, tuple[int, ...]]:
    return {}



def encode_words(names: pa.Array, spec: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of each word: flat ids and the words' offsets into them."""
    t, whole, memory = loaded(spec), whole_tokens(spec), _remembered(spec)
    table: dict[str, int] = {}  # pre-token or odd word: its place in ``parts``
    place: list[int] = []  # of each word's pre-tokens
    per = np.empty(len(names), np.int32)
    plain, split = _PLAIN.fullmatch, _SPLIT.findall
    for i, w in enumerate(names.to_pylist()):
        low = w.lower()
        if plain(w) and _SPECIAL not in w:
            found = [low] if low.isalpha() or low in whole else split(low)
        else:
            found = ["\0" + w]  # to the library as it is
        per[i] = len(found)
        for p in found:
            place.append(table.setdefault(p, len(table)))
    if len(memory) > REMEMBERED:
        memory.clear()
    parts = list(table)
    new = [p for p in parts if p not in whole and p not in memory]
    odd = [p for p in new if p[0] == "\0"]
    for p, e in zip(odd, t.encode_batch_fast([p[1:] for p in odd], add_special_tokens=False)):
        memory[p] = tuple(e.ids)
    merge = t.model.tokenize
    for p in new:
        if p[0] != "\0":
            memory[p] = tuple([x.id for x in merge(p if p.isascii() else p.translate(_LETTERS))])
    ids = [(whole[p],) if p in whole else memory[p] for p in parts]
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((x for y in ids for x in y), np.uint32, int(n.sum()))
    starts = np.cumsum(n) - n
    at = np.array(place, np.int64)
    words = ragged(flat, starts[at], n[at])
    ends = np.concatenate([[0], np.cumsum(per, dtype=np.int64)])
    return words, np.concatenate([[0], np.cumsum(n[at])])[ends]
