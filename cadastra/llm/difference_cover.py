"""Suffix order of a byte buffer, deep enough for prefixes of a given length, by the difference-cover method.

A character is eight bytes; the suffix at byte i goes on at i + 8. Of each chain of suffixes two of three are sampled. Triples
of characters of the sampled ones are sorted and named, the names recursed on (a triple of names spans three times the bytes)
until names span the prefix, the rest is sorted by a character and the name behind it, and both are merged.
"""

from __future__ import annotations

import numpy as np

CHARACTER = 8


#: Names of a buffer fit into so many bits, so that three make one key; longer buffers are refused.
BITS = 21


def _names(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of keys, from 1."""
    order = np.argsort(keys)
    ordered = keys[order]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else 0
    return names


def _ranks(char: np.ndarray, at: np.ndarray, step: int, spans: int, depth: int) -> np.ndarray:
    """Ranks of the suffixes at positions ``at`` that agree with the order of their first ``depth`` bytes.

    ``char`` has the name of each position's character, 0 where there is none; it spans ``spans`` bytes, and the next one is
    ``step`` bytes on. Places in a chain count from its start, modulo 3.
    """
    place = at // step % 3
    rest, first, second = (at[place == k] for k in range(3))
    sample = np.concatenate([first, second])
    pair = lambda a, b: a << BITS | b
    after = lambda x, k: char[x + k * step]
    name = np.zeros(len(char), np.int64)
    name[sample] = _names(pair(pair(char[sample], after(sample, 1)), after(sample, 2)))
    if 3 * spans < depth and len(sample) and name[sample].max() < len(sample):
        name[sample] = _ranks(name, sample, 3 * step, 3 * spans, depth)

    # Against the first of a chain's two samples a character and a name decide, against the second two characters and a name.
    short = lambda x: pair(char[x], name[x + step])
    deep = lambda x: pair(pair(char[x], after(x, 1)), name[x + 2 * step])
    rest = rest[np.argsort(short(rest))]
    key, deep_key = short(rest), np.maximum.accumulate(deep(rest))
    by_name = sample[np.argsort(name[sample])]
    second_of = by_name // step % 3 == 2
    first, second = by_name[~second_of], by_name[second_of]
    first_key, second_key = short(first), np.maximum.accumulate(deep(second))
    slot = np.empty(len(char), np.int64)
    slot[by_name] = np.arange(len(by_name))
    slot[first] += np.searchsorted(key, first_key, "right")
    slot[second] += np.searchsorted(deep_key, second_key, "right")
    slot[rest] = np.arange(len(rest)) + np.searchsorted(np.maximum.accumulate(first_key), key) + np.searchsorted(second_key, deep_key)
    ranks = np.empty(len(at), np.int64)
    ranks[np.argsort(slot[at], kind="stable")] = np.arange(1, len(at) + 1)
    return ranks


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``data`` (bytes) in the order of their suffixes, as far as ``depth`` bytes tell them apart."""
    n = len(data)
    if n >= (1 << BITS) - 1:
        raise ValueError(f"a buffer has less than {(1 << BITS) - 1} bytes")
    padded = np.concatenate([data, np.zeros(CHARACTER, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, CHARACTER)[:n].copy().view(">u8")[:, 0].astype(np.uint64)
    at = np.arange(n)
    char = np.concatenate([_names(windows), np.zeros(4 * depth + 64, np.int64)])
    ranks = _ranks(char, at, CHARACTER, CHARACTER, depth)
    order = np.empty(n, np.int64)
    order[ranks - 1] = at
    return order


def repeated(data: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """For each wanted start, ascending: does its string of ``length`` bytes start at another wanted place as well?

    Equal strings are neighbours in suffix order, so only adjacent prefixes are compared.
    """
    is_wanted = np.zeros(len(data), bool)
    is_wanted[wanted] = True
    order = suffix_order(data, length)
    order = order[is_wanted[order]]
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    for k in range(0, length, CHARACTER):
        at = min(k, length - CHARACTER)
        words = [np.lib.stride_tricks.sliding_window_view(data, CHARACTER)[x[same] + at].copy().view("<u8")[:, 0] for x in (a, b)]
        same = same[words[0] == words[1]]
    found = np.zeros(len(data), bool)
    found[a[same]] = found[b[same]] = True
    return found[wanted]
