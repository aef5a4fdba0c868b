"""Token ids of whole texts by a public tokenizer file, with a bounded memory of words seen before.

Both tokenizers cut a text into pre-tokens that never reach over a single space, so a text's ids are those of its
space-separated parts in a row. A worker keeps the ids of parts, packed as little-endian 16-bit numbers, and asks the
tokenizers library only for new ones. Texts where a part could depend on its neighbours are encoded whole.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of parts and their ids that a worker remembers, about; beyond it, what wasn't met again for a while is dropped.
REMEMBERED = 64 << 20
#: Bytes of texts that are cut into parts at a time, about; more of them look a part up less often.
TOGETHER = 1 << 20
#: Longer parts are encoded each time instead of being remembered.
LONGEST = 64


class Memory:
    """Ids of strings, in two generations: when the younger is full, the older is dropped, and what is met moves up."""

    def __init__(self, limit: int = REMEMBERED):
        self.half = limit // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def get(self, parts: list[str]) -> list[bytes | None]:
        """Ids of every part, None where they aren't remembered."""
        if self.size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        found = list(map(self.young.get, parts))
        if self.old:
            again = {}
            for i, ids in enumerate(found):
                if ids is None and (ids := self.old.get(parts[i])) is not None:
                    found[i] = again[parts[i]] = ids
            self.add(again)
        return found

    def missing(self, parts: set[str]) -> list[str]:
        """Those of `parts` that aren't remembered."""
        listed = list(parts)
        return [p for p, ids in zip(listed, self.get(listed), strict=True) if ids is None]

    def add(self, found: dict[str, bytes]) -> None:
        self.young.update(found)
        # with the objects' heads and the table's share
        self.size += 190 * len(found) + sum(map(len, found)) + sum(map(len, found.values()))


#: Pre-tokens of the word vocabulary, for lower-case texts of ASCII and Latin-1 letters; taken from the tokenizer file.
PLAIN = re.compile(r"[\x00-\x7Eß-öø-ÿ]*\Z")
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \t-\r]+")
#: Between the parts of a text for the byte-level vocabulary; texts that hold it go whole.
CUT = "\0"
#: For Arrow's expressions: what isn't lowered alike everywhere, a mark after a letter, a line end between two characters.
ODD = r"[^\x00-\x7EÀ-ÖØ-öø-ÿ]"
MARKED = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~])"
LINE_END = r"([!-~À-ÖØ-öø-ÿ])\n([!-~À-ÖØ-öø-ÿ])"
BLANK = re.compile(r"\s")


class WordEncoder:
    """encode(texts) -> list of little-endian uint16 id strings, equal to encoding every text whole.

    `joined`: a space belongs to the word after it (byte-level BPE); otherwise spaces are dropped.
    """

    def __init__(self, path: str, joined: bool, remembered: int = REMEMBERED, together: int = TOGETHER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids above 65535 don't fit")
        self.joined = joined
        self.known = Memory(remembered)
        self.together = together
        if joined:  # ids whose text begins with a space, as the first id of every part does and no other
            space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
            self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.opens[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(space)]] = True
            self.line = self._whole(["\n"])[0]
        else:  # pre-tokens go without normalizer and pattern, each ends with an id of its own kind
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

            self.lean = Tokenizer.from_file(path)
            self.lean.encode_special_tokens = True
            self.lean.normalizer = None
            self.lean.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
            self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.closes[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of every part. One text of many parts takes the library much less time."""
        if self.joined:
            return self._cut(self.tokenizer, parts) or self._whole(parts)
        # most are words of lower-case letters, which are one pre-token each
        out = dict.fromkeys(p for p in parts if p.isalpha() and p.islower() and (p.isascii() or PLAIN.match(p)))
        words = list(out)
        cut = {p: PRE_TOKEN.findall(p.lower()) for p in parts if p not in out and PLAIN.match(p.lower())}
        words += set().union(*cut.values()).difference(out)
        out.update(zip(words, (self._cut(self.lean, words) or self._whole(words)) if words else [], strict=True))
        out.update([(p, b"".join([out[t] for t in tokens])) for p, tokens in cut.items()])
        odd = [p for p in parts if p not in out]
        out.update(zip(odd, self._whole(odd), strict=True))
        return [out[p] for p in parts]

    def _cut(self, tokenizer, parts: list[str]) -> list[bytes] | None:
        """Ids of each part out of those of one text; None if they don't show where the parts are."""
        if "" in parts:
            return None
        text = ("" if self.joined else " ").join(parts)
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")
        first = np.flatnonzero(self.opens[ids]) if self.joined else np.append(0, np.flatnonzero(self.closes[ids])[:-1] + 1)
        if len(first) != len(parts) or len(ids) and first[0]:
            return None
        packed, cuts = ids.tobytes(), [*(2 * first).tolist(), 2 * len(ids)]
        return [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(x.ids, "<u2").tobytes() for x in found]

    def _learn(self, parts: list[str]) -> list[bytes]:
        """Ids of every one of the parts, which are distinct; the short ones are remembered."""
        found = self.known.get(parts)
        at = [i for i, ids in enumerate(found) if ids is None]
        new = [parts[i] for i in at]
        kinds = [(self._parts, new)]
        if self.joined:
            blank = {p for p in new if p in ("", " ") or BLANK.search(p.removeprefix(" "))}
            spaced = [p for p in new if p[:1] == " " and p not in blank]
            kinds = [(self._whole, list(blank)), (self._parts, spaced)]
            kinds.append((self._bare, [p for p in new if p[:1] != " " and p not in blank]))
        coded: dict[str, bytes] = {}
        for code, some in kinds:
            for i in range(0, len(some), 4096):
                coded.update(zip(some[i : i + 4096], code(some[i : i + 4096]), strict=True))
        for i, p in zip(at, new, strict=True):
            found[i] = coded[p]
        self.known.add({p: ids for p, ids in coded.items() if len(p) <= LONGEST})
        return found

    def _bare(self, words: list[str]) -> list[bytes]:
        """Ids of words or marks without a space before them: each is a line of one text."""
        packed = self._whole(["".join(["\n" + w for w in words])])[0]
        ids = np.frombuffer(packed, "<u2")
        first = 2 * np.flatnonzero(ids == np.frombuffer(self.line, "<u2")[0])
        if len(first) != len(words) or first[0]:
            return self._whole(words)
        return [packed[a + 2 : b] for a, b in zip(first.tolist(), [*first[1:].tolist(), len(packed)], strict=True)]

    def _prepared(self, texts: pa.Array) -> tuple[pa.Array, str]:
        """Texts with the returned separator between parts that no pre-token reaches over."""
        if self.joined:  # a part keeps the space before it
            texts = pc.replace_substring_regex(texts, MARKED, rf"\1{CUT}\2")
            texts = pc.replace_substring_regex(texts, LINE_END, f"\\1{CUT}\n{CUT}\\2")
            return pc.replace_substring(texts, " ", CUT + " "), CUT
        texts = pc.if_else(pc.match_substring_regex(texts, ODD), texts, pc.utf8_lower(texts))
        texts = pc.replace_substring(texts, "\n", " ")
        return pc.replace_substring_regex(texts, MARKED, r"\1 \2"), " "

    def _together(self, texts: pa.Array) -> list[np.ndarray]:
        whole: list[int] = []
        if self.joined:  # a run of spaces is cut by its length, so such texts go whole
            runs = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, CUT))
            whole = np.flatnonzero(runs.to_numpy(zero_copy_only=False)).tolist()
        plain = pc.if_else(runs, pa.scalar("", pa.large_string()), texts) if whole else texts
        cut = pc.split_pattern(*self._prepared(plain))
        parts, cuts = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
        del cut  # as large as the texts
        found = self._learn(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(found), "<u2")
        size = np.fromiter(map(len, found), np.int32, len(found)) // 2
        first = np.cumsum(size, dtype=np.int32) - size
        which = parts.indices.to_numpy()
        sizes = size[which]
        until = np.cumsum(sizes, dtype=np.int64)
        # the place in `ids` of every id of every part in a row
        at = np.repeat(first[which] - (until - sizes), sizes)
        at += np.arange(len(at))
        ids = ids[at]
        ends = np.append(0, until)[cuts].tolist()
        out = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for i, packed in zip(whole, self._whole(texts.take(whole).to_pylist()) if whole else [], strict=True):
            out[i] = np.frombuffer(packed, "<u2")
        return out

    def encode_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text, as little-endian 16-bit numbers; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        start = 0
        while start < len(texts):
            so_far = int(ends[start - 1]) if start else 0
            until = max(start + 1, int(np.searchsorted(ends, so_far + self.together, side="right")))
            yield from self._together(texts.slice(start, until - start))
            start = until

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.encode_column(pa.array(texts, pa.large_string()))]


@lru_cache(maxsize=1)
def encoder_of(path: str, joined: bool, remembered: int = REMEMBERED, together: int = TOGETHER) -> WordEncoder:
    """The worker's encoder: its later tasks go on with what it remembers, `remembered` bytes at most."""
    release_memory()
    return WordEncoder(path, joined, remembered, together)


def forget_encoder() -> None:
    """Frees what the worker's encoder remembers; tasks of other stages call it before they fill memory of their own."""
    if encoder_of.cache_info().currsize:
        encoder_of.cache_clear()
        release_memory()


def release_memory() -> None:
    """Gives back to the system what a worker's earlier tasks have freed, and Arrow and the C library still hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def as_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u2").astype("<u4")
