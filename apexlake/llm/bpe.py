"""BPE encoding with a pair occurrence index, exact decoding, and token counts with a whole-token shortcut.

A tokenizer file (vocabulary, merges, word ends, lower case) is read once on
the driver and sent to the tasks: about 2 MB, bounded by the vocabulary. Texts
stay where they are; nothing is shuffled. Within a piece of text each distinct
pre-token is merged once:

* all distinct pre-tokens lie in one array of symbols with links to the
  neighbours; an index maps every mergeable pair to all its positions;
* ranks are taken in ascending order; all positions of a rank are merged at
  once and the pairs that arise at their borders join their own lists.

A merge of rank r builds a symbol that only merges of a higher rank use, so
ascending order over the piece gives each word the order it would have alone
(checked when the file is read).

Results: null is an empty text and has no tokens. Strings of special tokens
inside a text become those tokens. Repeated rows get equal results, an empty
table gives an empty one, extra columns pass through, and an input column named
like a result is replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apexlake.llm.common import append_columns

WORD_END = "</w>"
# Distinct pre-tokens a worker remembers between pieces; beyond it starts afresh (memory only, results are the same).
REMEMBERED = 300_000
# Where a list of ids and a text are kept for each word, and returned for each text: less at once.
REMEMBERED_LISTS, LIST_PIECE_BYTES = 120_000, 1 << 20


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


# The quick path: characters whose lower case and kind need no Unicode tables beyond these.
_QUICK = [*range(0x180), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]
_UNUSUAL = re.compile(r"[^\x00-ſ‐-‧‰-⁞]")


def _quick_pattern() -> re.Pattern:
    kinds = {"L": "", "N": "", "S": ""}
    for code in _QUICK:
        c = chr(code)
        space = c.isspace() and not 0x1C <= code <= 0x1F
        kind = "S" if space else unicodedata.category(c)[0]
        if kind in "LN" or space:
            kinds[kind] += re.escape(c)
    letters, numbers, spaces = kinds["L"], kinds["N"], kinds["S"]
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class Vocabulary:
    """Symbols, merges and pre-tokens of one tokenizer file."""

    def __init__(self, source: str):
        self.source = source
        config = json.loads(source)
        model = config["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("a BPE file with word ends is needed")
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        special = [t for t in config["added_tokens"] if t["special"]]
        self.special = {t["content"]: t["id"] for t in special}
        self.tokens = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if special else None
        self.size = max(self.tokens) + 1
        made = [self.ids[a + b] for a, b in pairs]
        first = {s: r for r, s in reversed([*enumerate(made)])}
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        if len(first) != len(made) or any(max(first.get(a, -1), first.get(b, -1)) >= r for r, (a, b) in enumerate(zip(left.tolist(), right.tolist()))):
            raise ValueError("merges must build each symbol once, and before it is used")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.merges = [*zip(left.tolist(), right.tolist(), made)]
        chars = _byte_characters()
        self.inner = np.array([self.ids[c] for c in chars], np.int64)
        self.last = np.array([self.ids[c + WORD_END] for c in chars], np.int64)
        self.byte_of = {c: b for b, c in enumerate(chars)}
        self.quick = _quick_pattern()
        self._library = None

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens appear as their own strings."""
        if self.split_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[str] = []
        for k, part in enumerate(self.split_special.split(text)):
            out += [part] if k % 2 else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if _UNUSUAL.search(text) is None:
            return self.quick.findall(text.lower())
        if self._library is None:  # its normaliser and splitter carry their own Unicode tables
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source)
        split = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, word)).decode() for word, _ in split]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 for pairs that never merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge(self, words: list[str]) -> list[list[int]]:
        """Token ids of distinct pre-tokens, merged together through a pair occurrence index."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(w) for w in raw])
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        n = len(symbol)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[np.r_[0, ends[:-1]]] = -1

        # The index: rank of a pair -> all positions where it begins. Stale positions are passed over when used.
        occurrences: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            """Index the pairs that begin at these positions."""
            rank = self.rank_of(symbol[at], symbol[after[at]])
            rank[after[at] < 0] = -1
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            first = np.searchsorted(rank, 0)
            cuts = [first, *(np.flatnonzero(rank[first + 1:] != rank[first:-1]) + first + 1).tolist(), len(at)]
            for r, s, e in zip(rank[cuts[:-1]].tolist() if first < len(at) else [], cuts, cuts[1:]):
                if r in occurrences:
                    occurrences[r].append(at[s:e])
                else:
                    occurrences[r] = [at[s:e]]
                    heapq.heappush(active, r)

        add(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            lists = occurrences.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, made = self.merges[rank]
            at = at[symbol[at] == a]
            gone = after[at]
            fits = (gone >= 0) & (symbol[gone] == b)
            at, gone = at[fits], gone[fits]
            if a == b and len(at) > 1:  # in a run of equal symbols pairs are taken from the left
                at = np.unique(at)
                taken, blocked = [], -1
                for p, q in zip(at.tolist(), after[at].tolist()):
                    if p != blocked:
                        taken.append(p)
                        blocked = q
                at = np.array(taken, np.int64)
                gone = after[at]
            if not len(at):
                continue
            following = after[gone]
            symbol[at], symbol[gone] = made, -1
            after[at] = following
            inside = following >= 0
            before[following[inside]] = at[inside]
            ahead = before[at]
            add(np.concatenate([at[inside], ahead[ahead >= 0]]))
        kept = np.flatnonzero(symbol >= 0)
        cuts = np.searchsorted(kept, ends).tolist()
        values = symbol[kept].tolist()
        return [values[s:e] for s, e in zip([0, *cuts[:-1]], cuts)]


class Memory(dict):
    """What is known of pre-tokens: forgets when full, learns the missing ones of a piece together."""

    def __init__(self, fixed: dict, learn, most: int = REMEMBERED):
        super().__init__(fixed)
        self.fixed, self.learn, self.most = fixed, learn, most

    def know(self, lists: list[list[str]]) -> None:
        wanted = set().union(*lists) if lists else set()
        if len(self) + len(wanted) > self.most + len(self.fixed):
            self.clear()
            self.update(self.fixed)
        missing = [w for w in wanted if w not in self]
        self.update(zip(missing, self.learn(missing)))


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


_loaded: dict[str, Vocabulary] = {}


def _vocabulary(source: str) -> Vocabulary:
    """One per worker process, whatever the number of tasks."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = Vocabulary(source)
    return _loaded[key]


ENCODED = T.StructType([
    T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
])


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``token_ids`` and ``decoded``, the text those ids stand for."""
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        vocabulary = _vocabulary(source.value)
        token = vocabulary.tokens
        fixed = {s: ([i], s) for s, i in vocabulary.special.items()}
        memory = Memory(
            fixed, lambda words: [(ids, " ".join([token[i] for i in ids])) for ids in vocabulary.merge(words)], REMEMBERED_LISTS)

        def run(texts):
            lists = [vocabulary.pre_tokens(t) if t else [] for t in texts.to_pylist()]
            memory.know(lists)
            ids, decoded = [], []
            for words in lists:
                found = [memory[w] for w in words]
                ids.append([i for own, _ in found for i in own])
                decoded.append(" ".join([s for _, s in found]))
            return ids, decoded

        return run

    return append_columns(docs, text, ENCODED, make, LIST_PIECE_BYTES)


DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def encode_digest(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add the number of tokens and digests of ids and decoded text, without keeping either."""
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def make():
        vocabulary = _vocabulary(source.value)
        token = vocabulary.tokens
        fixed = {s: (1, str(i), s) for s, i in vocabulary.special.items()}
        memory = Memory(fixed, lambda words: [
            (len(ids), " ".join(map(str, ids)), " ".join([token[i] for i in ids])) for ids in vocabulary.merge(words)
        ])

        def run(texts):
            lists = [vocabulary.pre_tokens(t) if t else [] for t in texts.to_pylist()]
            memory.know(lists)
            counts, ids, decoded = [], [], []
            for words in lists:
                found = [memory[w] for w in words]
                counts.append(sum([x[0] for x in found]))
                ids.append(hashlib.sha256(" ".join([x[1] for x in found]).encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join([x[2] for x in found]).encode()).hexdigest())
            return counts, ids, decoded

        return run

    return append_columns(docs, text, DIGEST, make)


def decode(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """The text that an array of ids stands for, as a join of their strings by one space.

    Null for null. An id outside the vocabulary stands for nothing and is left out, as in the library.
    """
    vocabulary = Vocabulary(read_vocabulary(path))
    strings = F.broadcast(docs.sparkSession.createDataFrame(
        [([vocabulary.tokens.get(i) for i in range(vocabulary.size)],)], "_strings array<string>"))
    joined = docs.crossJoin(strings)  # one row, bounded by the vocabulary
    known = F.filter(F.transform(F.col(ids), lambda i: F.get("_strings", i)), lambda s: s.isNotNull())
    return joined.withColumn(out, F.when(F.col(ids).isNotNull(), F.array_join(known, " "))).drop("_strings")


def whole_tokens(vocabulary: Vocabulary) -> list[str]:
    """Pre-tokens proved to be one token: each vocabulary string with a word end is merged and must give itself."""
    candidates = []
    for s, i in vocabulary.ids.items():
        if s.endswith(WORD_END) and len(s) > len(WORD_END):
            try:
                raw = bytes(map(vocabulary.byte_of.__getitem__, s[: -len(WORD_END)])).decode()
            except (KeyError, UnicodeDecodeError):
                continue  # part of a character: never a whole pre-token
            if raw not in vocabulary.special:
                candidates.append((raw, i))
    merged = vocabulary.merge([w for w, _ in candidates])
    return [w for (w, i), ids in zip(candidates, merged) if ids == [i]]


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens. Whole tokens are counted as they are; only other pre-tokens are merged."""
    source = read_vocabulary(path)
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((source, whole_tokens(_vocabulary(source))))

    def make():
        source, whole = sent.value
        vocabulary = _vocabulary(source)
        fixed = dict.fromkeys(whole, 1) | dict.fromkeys(vocabulary.special, 1)
        memory = Memory(fixed, lambda words: [len(ids) for ids in vocabulary.merge(words)])

        def run(texts):
            lists = [vocabulary.pre_tokens(t) if t else [] for t in texts.to_pylist()]
            memory.know(lists)
            return ([sum([memory[w] for w in words]) for words in lists],)

        return run

    return append_columns(docs, text, T.StructType([T.StructField(out, T.LongType())]), make)
