"""Ids of a byte-level vocabulary of the tokenizers library from its ranks, where that gives the same.

Encoding from ranks (tiktoken) is several times faster than the library's own path. Both give the same ids if the merges in
their order are the tokens in the order of their ids, the words are split the same way, and both take every character of the
text for the same kind, which depends on their versions of Unicode. ``Ranked.takes`` says whether all that holds for a text;
any other goes to the library.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np

_WORKER: dict = {}
#: Fixed value: how byte-level vocabularies split a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that every version of Unicode, and so every library, takes for the same kind.
_SETTLED = re.compile(r"[\t\n -~¡-¬®-ɏΑ-ΡΣ-ωА-я]*")


def byte_level_letters() -> list[str]:
    """The letter a byte-level vocabulary writes for each byte: printable ones stand for themselves, the others move up from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(moved)) for b in range(256)]


def bytes_of_ids(vocabulary: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary: its entry with the letters read back; added tokens as they stand."""
    rules = json.loads(vocabulary)
    if (rules.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        return []
    byte = {letter: bytes([b]) for b, letter in enumerate(byte_level_letters())}
    entries, added = rules["model"]["vocab"], {t["id"]: t["content"].encode() for t in rules["added_tokens"]}
    tokens = [b""] * (max([*entries.values(), *added]) + 1)
    for entry, k in entries.items():
        tokens[k] = added[k] if k in added else b"".join(map(byte.__getitem__, entry))
    for k, content in added.items():
        tokens[k] = content
    return tokens


def ranks_of(vocabulary: str, tokens: list[bytes]) -> dict[bytes, int] | None:
    """Tokens with their ranks, if the merges in their order are the tokens in the order of their ids, and words are split as ``WORDS``."""
    rules = json.loads(vocabulary)
    model, before = rules["model"], rules.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not rules.get("normalizer")
    if not plain or model.get("dropout") or model.get("ignore_merges") or model.get("unk_token") or model.get("end_of_word_suffix"):
        return None
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    bytes_ = [k for k, t in enumerate(tokens) if len(t) == 1]
    if merged != sorted(set(merged)) or len(bytes_) != 256 or max(bytes_) > merged[0]:
        return None
    return {tokens[k]: k for k in [*bytes_, *merged]}


class Ranked:
    """One vocabulary. ``special_strings``: those of added tokens inside a text are their ids, not plain text."""

    def __init__(self, vocabulary: str, special_strings: bool):
        from tiktoken import Encoding

        ranks = ranks_of(vocabulary, bytes_of_ids(vocabulary))
        self._encoding = ranks and Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self._special = [t["content"] for t in json.loads(vocabulary)["added_tokens"]] if special_strings else []

    def takes(self, text: str) -> bool:
        return self._encoding is not None and _SETTLED.fullmatch(text) is not None and not any(s in text for s in self._special)

    def ids(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(text)

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return np.array(self.ids(text), "<u4").tobytes()


def ranked_on_worker(vocabulary: str) -> Ranked:
    """One per vocabulary and worker process, with special strings as their ids."""
    key = hashlib.sha256(vocabulary.encode()).digest()
    if key not in _WORKER:
        _WORKER[key] = Ranked(vocabulary, special_strings=True)
    return _WORKER[key]
