"""Encoding with a tokenizer file inside tasks.

Byte-level BPE never joins what its pattern splits, and the pattern splits before every single
space or line end between two visible characters. Text is therefore encoded unit by unit, a unit
reaching from such a place to the next one, and the ids of units seen lately are kept: the tokenizer
encodes each unit once, not each time it occurs. It also splits between a letter or digit and the
punctuation behind it, so a new unit with such an end is put together from two shorter ones.

A slice of texts is split and numbered by Arrow; Python sees each different unit of a slice once, and numpy
puts the ids of all units one after the other.
"""

from __future__ import annotations

import os
import re
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LATELY = 400_000
SHORT = 48
SLICE = 5_000_000
# A space between two visible characters.
_BORDER = re.compile(r"(?<=\S) (?=\S)")
_ALNUM = np.array([chr(c).isascii() and chr(c).isalnum() for c in range(256)])
_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def _is_odd(text: str, gap: str) -> bool:
    """Whether some gap (a space or line end) is not between two visible characters.

    Plain strings are found faster than patterns, and a text holds few kinds of white space.
    """
    if text[:1] == gap or text[-1:] == gap:
        return True
    return gap in text and any(x + gap in text or gap + x in text for x in _WHITE if x in text)


def has_odd_space(text: str) -> bool:
    return _is_odd(text, " ")


def is_plain(unit: str) -> bool:
    """Whether a unit is surely without white space; units with signs that do not print count as not."""
    return unit.isprintable() and " " not in unit and unit != ""


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of all given starts and lengths, one after the other."""
    before, total = np.cumsum(lengths) - lengths, int(lengths.sum())
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    places = np.repeat((starts - before).astype(kind), lengths)
    places += np.arange(total, dtype=kind)
    return flat[places]


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def parted(units: pa.LargeStringArray) -> tuple[pa.DictionaryArray, pa.DictionaryArray]:
    """Units as a core and the punctuation at its end, which is empty where the pattern might not split there.

    It does split behind an ASCII letter or digit and behind letters of the Latin blocks after it.
    """
    cores = pc.ascii_rtrim(units, characters=string.punctuation)
    size, kept = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (units, cores))
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(units.buffers()[1], np.int64)[units.offset : units.offset + len(units)]
    last = data[np.maximum(offsets + kept - 1, 0)] if len(data) else np.zeros(len(units), np.uint8)
    lead = data[np.maximum(offsets + kept - 2, 0)] if len(data) else last
    latin = (lead >= 0xC3) & (lead <= 0xC9) & ((lead > 0xC3) | ((last != 0x97) & (last != 0xB7)))
    split = np.where(last < 0x80, _ALNUM[last], latin & (kept > 1)) & (kept > 0)
    ends = np.where(split, size - kept, 0)
    text = ragged(data, offsets + kept, ends) if len(data) else data
    borders = np.concatenate([[0], np.cumsum(ends)]).astype(np.int64)
    tails = pa.LargeStringArray.from_buffers(len(units), pa.py_buffer(borders), pa.py_buffer(text.tobytes()))
    return pc.if_else(pa.array(split), cores, units).dictionary_encode(), tails.dictionary_encode()


class UnitEncoder:
    """Texts to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        tokens = self.tokenizer.get_vocab()
        # Which ids begin with a space; byte-level vocabularies write it as this letter.
        self.begins = np.zeros(max(tokens.values()) + 1, bool)
        self.begins[[number for token, number in tokens.items() if token.startswith("\u0120")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def unit_ids(self, units: list[str]) -> list[bytes]:
        """The ids of units behind a space each, or with the line end they begin with.

        Units without white space are joined, a few hundred to a text: the only spaces there
        are those between them, so the ids that begin with a space begin the units.
        """
        found = dict.fromkeys(units, b"")
        plain = list(filter(is_plain, units))
        runs = [plain[i : i + 500] for i in range(0, len(plain), 500)]
        joined = self.tokenizer.encode_batch_fast(["".join([" " + u for u in run]) for run in runs], add_special_tokens=False)
        for run, encoded in zip(runs, joined, strict=True):
            ids = np.array(encoded.ids, "<u4")
            places = (4 * np.flatnonzero(self.begins[ids])).tolist()
            if len(places) != len(run):
                raise ValueError("the tokenizer does not begin each unit with a space")
            data = ids.tobytes()
            for unit, low, high in zip(run, places, [*places[1:], len(data)], strict=True):
                found[unit] = data[low:high]
        odd = [u for u in units if not found[u]]
        shown = [u if u[:1] == "\n" else " " + u for u in odd]
        for unit, ids in zip(odd, self.ids(shown), strict=True):
            found[unit] = ids
        return list(found.values())

    def look_up(self, units: list[str]) -> list[bytes]:
        """The ids of different units; the tokenizer sees what is new."""
        young, old = self.young, self.old
        found = list(map(young.get, units))
        missing = [k for k, ids in enumerate(found) if ids is None]
        new = []
        for k in missing:
            ids = old.get(units[k])
            if ids is None:
                new.append(k)
            else:
                found[k] = young[units[k]] = ids
        for k, ids in zip(new, self.unit_ids([units[k] for k in new]), strict=True):
            found[k] = ids
            if len(units[k]) <= SHORT:
                young[units[k]] = ids
        if len(young) >= LATELY:
            self.young, self.old = {}, young
        return found

    def end_ids(self, ends: list[str]) -> list[bytes]:
        """The ids of runs of punctuation that have no space before them."""
        new = [e for e in ends if e not in self.ends]
        found = dict(zip(new, self.ids(new), strict=True))
        ids = [self.ends[e] if e in self.ends else found[e] for e in ends]
        if len(self.ends) < LATELY:
            self.ends |= {e: x for e, x in found.items() if len(e) <= SHORT}
        return ids

    def _joined(self, units: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are given as their units, and how many each text has."""
        counts = pc.list_value_length(units).to_numpy()
        numbered = units.flatten().dictionary_encode()
        place = numbered.indices.to_numpy().astype(np.int64)
        # Only a head has no space before it. It may be the whole text, so it is no unit to keep.
        first = np.cumsum(counts) - counts
        heads = numbered.dictionary.take(pa.array(place[first]))
        place[first] = -1
        used = np.unique(place)[1 if len(first) else 0 :]
        renumbered = np.zeros(len(numbered.dictionary) + 1, np.int64)
        renumbered[used] = np.arange(len(used))
        place = renumbered[place]
        cores, ends = parted(numbered.dictionary.take(pa.array(used)))
        # In order: no id at all, the cores, the ends, the heads.
        ids = [b"", *self.look_up(strings(cores.dictionary)), *self.end_ids(strings(ends.dictionary))]
        ids += self.ids(strings(heads))
        after_cores = 1 + len(cores.dictionary)
        core = 1 + cores.indices.to_numpy().astype(np.int64)
        end = after_cores + ends.indices.to_numpy().astype(np.int64)
        both = np.zeros((len(place), 2), np.int64)
        if len(core):
            both[:, 0], both[:, 1] = core[place], end[place]
        both[first, 0] = after_cores + len(ends.dictionary) + np.arange(len(first))
        both[first, 1] = 0
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        both = both.ravel()
        many = lengths[both]
        return ragged(flat, (np.cumsum(lengths) - lengths)[both], many), np.add.reduceat(many, 2 * first)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        ids, counts = self.flat(texts)
        data, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        return [data[low:high] for low, high in zip([0, *ends[:-1]], ends, strict=True)] if texts else []

    def flat(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each one has.

        An end id, if given, goes behind each text and is counted.
        """
        ids, counts = self._flat(texts)
        if end_id is None:
            return ids, counts
        return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        odd = [has_odd_space(t) for t in texts]
        # A line end inside begins a unit of its own, where no white space is next to it.
        plain = [
            t if "\n" not in t or _is_odd(t, "\n") else t.replace("\n", " \n")
            for t, is_odd in zip(texts, odd, strict=True)
            if not is_odd
        ]
        parts = []
        if plain:
            parts.append(self._joined(pc.split_pattern(pa.array(plain, pa.large_string()), " ")))
        if len(plain) < len(texts):
            split = [_BORDER.split(t) for t, is_odd in zip(texts, odd, strict=True) if is_odd]
            parts.append(self._joined(pa.array(split, pa.list_(pa.large_string()))))
        if len(parts) == 1:
            return parts[0]
        ids, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Texts come back in their own order.
        back = np.argsort(np.argsort(odd, kind="stable"), kind="stable")
        return ragged(ids, (np.cumsum(counts) - counts)[back], counts[back]), counts[back]


@lru_cache(maxsize=2)
def unit_encoder(path: str) -> UnitEncoder:
    """One encoder per worker process and tokenizer file."""
    return UnitEncoder(path)


def slices(texts: list[str], chars: int = SLICE):
    """Ranges of the list that hold about so many characters, at least one text each."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
