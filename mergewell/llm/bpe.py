"""BPE encoding by speculation: greedy longest match, verified pair by pair."""

from __future__ import annotations

import gc
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The white space of the normalizer's pattern.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters and numbers younger than Unicode 16, which the library takes for symbols, as code point ranges.
YOUNGER = (
    "558-558 58B-58C 88F-88F C5C-C5C CDC-CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD A7E2-A7E2 A7F1-A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DF1-11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF "
    "18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 "
    "1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
#: The lower case of capitals of Unicode 16 and 17, which Python may not know yet.
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
#: Words, and as many chunks, that a worker remembers, and characters of the longest one.
CACHE_WORDS, CACHE_CHARS = 400_000, 64
#: Words of up to so many letters are merged side by side.
TOGETHER = 64
#: Documents and characters of one output batch.
BATCH_ROWS, BATCH_CHARS = 512, 4_000_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it is one, else the next from U+0100."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class Recent(dict):
    """What was learned lately: at half of ``CACHE_WORDS`` entries it begins anew and moves back what is asked for again."""

    def __init__(self) -> None:
        super().__init__()
        self.older: dict[str, list[int]] = {}

    def missing(self, keys: set[str]) -> set[str]:
        """The keys that are in neither half; the others are at hand from now on."""
        if len(self) > CACHE_WORDS // 2:
            self.older = dict(self)
            self.clear()
        keys = keys.difference(self)
        again = keys.intersection(self.older)
        self.update((k, self.older[k]) for k in again)
        return keys - again


class Bpe:
    """The tokenizer of a ``tokenizers`` JSON file with word-end BPE.

    Its normalizer is NFC, white space runs to one space, lower case; its words
    are the matches of the file's pattern as byte letters.
    """

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = pattern.replace("[^\\s", f"[^{SPACE}")
        self.words = regex.compile(pattern)
        young = "".join(f"\\U{int(a, 16):08x}-\\U{int(b, 16):08x}" for a, b in (r.split("-") for r in YOUNGER.split()))
        self.odd = regex.compile(f"[{young}{''.join(map(chr, LOWER))}]")
        own = [f"[\\p{{{c}}}--[{young}]]" for c in "LN"]
        self.words_with_odd = regex.compile("(?V1)" + pattern.split("|[")[0] + f"|{own[0]}+|{own[1]}|[^{SPACE}{own[0]}{own[1]}]+")
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.separators = regex.compile("[\\x1c-\\x1f]")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.letters = dict(enumerate(byte_letters()))
        #: A token's symbols: its letters, the last one with the word end if the token has it.
        self.inner = {t: i for t, i in vocab.items() if not t.endswith(self.end)}
        self.final = {t[: -len(self.end)]: i for t, i in vocab.items() if t.endswith(self.end)}
        self.longest = max(map(len, [*self.inner, *self.final]))
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges), strict=True))
        n = len(self.tokens)
        self.rank = dict(zip(zip(left.tolist(), right.tolist(), strict=True), range(len(made)), strict=True))
        self.made = made.tolist()
        self.n = n
        #: Sorted (left, right) keys with their ranks, and what each token was merged from and when.
        keys = left * n + right
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, -1)
        never = len(made)
        self.never = never
        self.born = np.full(n, -1, np.int64)
        self.born[made[::-1]] = np.arange(never)[::-1]
        self.left, self.right = np.arange(n), np.arange(n)
        self.left[made[::-1]], self.right[made[::-1]] = left[::-1], right[::-1]
        self.cache, self.chunks = Recent(), Recent()
        #: Only tokens that merging gives back are proposed.
        usable = {i for i in range(n) if self._rebuilt(i)}
        self.inner = {t: i for t, i in self.inner.items() if i in usable}
        self.final = {t: i for t, i in self.final.items() if i in usable}
        #: Tokens of single letters, within a word and, by those, at its end; what a merge makes.
        self.letter, self.letter_end, self.made_ids = np.full(512, n, np.int64), np.full(n + 1, n, np.int64), made
        for c in self.letters.values():
            self.letter[ord(c)] = self.inner[c]
            self.letter_end[self.inner[c]] = self.final[c]
        #: The longest token that begins with two given letters.
        self.reach: dict[str, int] = {}
        for t in self.inner:
            self.reach[t[:2]] = max(len(t), self.reach.get(t[:2], 0))

    def _rebuilt(self, i: int) -> bool:
        """Whether the merges that made token ``i`` came in the order of their ranks."""
        b = self.born[i]
        return b < 0 or bool(self.born[self.left[i]] < b and self.born[self.right[i]] < b)

    def greedy(self, word: str) -> list[int]:
        """Longest match from the left."""
        out, at, n = [], 0, len(word)
        inner, final, longest, reach = self.inner, self.final, self.longest, self.reach
        while at < n:
            if n - at <= longest and (i := final.get(word[at:])) is not None:
                out.append(i)
                break
            for k in range(min(reach.get(word[at : at + 2], 1), n - at - 1), 0, -1):
                if (i := inner.get(word[at : at + k])) is not None:
                    out.append(i)
                    at += k
                    break
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For adjacent tokens, whether no merge across their border comes before those that made them.

        Both tokens are run back in time: x is what touches the border in a,
        y in b. A merge of (x, y) would have happened if its rank is below
        that at which x became part of what follows on its left side, and not
        above that at which y became part of what follows on its right side.
        The later of the two is undone first.
        """
        x, y = a.copy(), b.copy()
        # the ranks at which x and y cease to touch the border; whole tokens never do
        until_x, until_y = np.full(len(x), self.never), np.full(len(x), self.never)
        good = np.ones(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            p, q = x[live], y[live]
            key = p * self.n + q
            at = np.searchsorted(self.keys, key)
            rank = np.where(self.keys[at] == key, self.ranks[at], self.never)
            bad = (rank < self.never) & (rank < until_x[live]) & (rank <= until_y[live])
            good[live[bad]] = False
            born_x, born_y = self.born[p], self.born[q]
            undo_x = born_x > born_y  # of equal ranks the left one came first
            more = ~bad & ((born_x >= 0) | (born_y >= 0))
            on_x, on_y = live[more & undo_x], live[more & ~undo_x]
            until_x[on_x], until_y[on_y] = self.born[x[on_x]], self.born[y[on_y]]
            x[on_x], y[on_y] = self.right[x[on_x]], self.left[y[on_y]]
            live = live[more]
        return good

    def merged(self, word: str) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost of equal ones."""
        ids = [self.inner[c] for c in word[:-1]] + [self.final[word[-1]]]
        rank, made = self.rank, self.made
        if len(ids) > 200:
            return self._merged_long(ids)
        never = self.never
        ranks = [rank.get(p, never) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < never:
            k = ranks.index(best)
            ids[k : k + 2] = [made[best]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get((ids[k - 1], ids[k]), never)
            if k < len(ranks):
                ranks[k] = rank.get((ids[k], ids[k + 1]), never)
        return ids

    def merged_together(self, words: list[str]) -> list[list[int]]:
        """The same for many words of up to ``TOGETHER`` letters: each round merges the best pair of every word that has one."""
        out: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        never, none = self.never, self.n
        low = 0
        for width in (4, 6, 8, 10, 12, 16, 24, 32, TOGETHER):
            at = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if not len(at):
                continue
            size = sizes[at]
            ids = self.letter[np.array([words[k] for k in at], f"U{width}").view(np.uint32).reshape(len(at), width)]
            ends = np.arange(len(at)), size - 1
            ids[ends] = self.letter_end[ids[ends]]
            ids[np.arange(width) >= size[:, None]] = none
            # a column more than pairs need: beyond the last there is none
            ranks = np.full((len(at), width), never)
            ranks[:, :-1] = self.rank_of(ids[:, :-1], ids[:, 1:])
            place = np.arange(width)
            while len(at):
                k = ranks.argmin(1)
                row = np.arange(len(at))
                best = ranks[row, k]
                done = best == never
                if done.any():
                    for j, word in zip(at[done].tolist(), ids[done].tolist(), strict=True):
                        out[j] = word[: word.index(none)] if word[-1] == none else word
                    more = ~done
                    at, ids, ranks, k, best = at[more], ids[more], ranks[more], k[more], best[more]
                    row = np.arange(len(at))
                    if not len(at):
                        break
                shifted = np.minimum(place + (place > k[:, None]), width - 1)
                last = ids[:, -1] != none
                ids, ranks = np.take_along_axis(ids, shifted, 1), np.take_along_axis(ranks, shifted, 1)
                ids[last, -1], ranks[:, -1] = none, never
                ids[row, k] = self.made_ids[best]
                ranks[row, k] = np.where(k + 1 < width, self.rank_of(ids[row, k], ids[row, np.minimum(k + 1, width - 1)]), never)
                inner = np.flatnonzero(k > 0)
                ranks[inner, k[inner] - 1] = self.rank_of(ids[inner, k[inner] - 1], ids[inner, k[inner]])
        return out

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens; those that do not merge, or go beyond a word, are last."""
        key = a * self.n + b
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (b < self.n) & (a < self.n), self.ranks[at], self.never)

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, for words of any length."""
        import heapq

        n = len(ids)
        after, before, ids = [*range(1, n), -1], [*range(-1, n - 1)], [*ids]
        rank, made = self.rank, self.made
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := rank.get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, p, q = heapq.heappop(heap)
            j = after[k] if ids[k] == p else -1
            if j < 0 or ids[j] != q:
                continue
            ids[k], ids[j] = made[r], -1
            after[k] = after[j]
            if after[k] >= 0:
                before[after[k]] = k
            for m in (before[k], k):
                if m >= 0 and after[m] >= 0 and (s := rank.get((ids[m], ids[after[m]]))) is not None:
                    heapq.heappush(heap, (s, m, ids[m], ids[after[m]]))
        return [i for i in ids if i >= 0]

    def learn(self, words: list[str], out: dict[str, list[int]]) -> int:
        """Encodes new words into ``out``; returns how many had to be merged exactly."""
        letters = self.letters
        spelled = [w.encode().decode("latin-1").translate(letters) for w in words]
        tokens = [self.greedy(s) for s in spelled]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter((i for t in tokens for i in t), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(tokens)), sizes)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        good = self.compatible(flat[inside], flat[inside + 1])
        failed = np.unique(owner[inside[~good]]).tolist()
        short = [k for k in failed if len(spelled[k]) <= TOGETHER]
        for k, ids in zip(short, self.merged_together([spelled[k] for k in short]), strict=True):
            tokens[k] = ids
        for k in failed:
            if len(spelled[k]) > TOGETHER:
                tokens[k] = self.merged(spelled[k])
        out.update(zip(words, tokens, strict=True))
        return len(failed)

    def split(self, text: str) -> list[str]:
        """The normalized text between white space; special tokens as their strings after a space."""
        parts = self.specials.split(text) if "<|" in text else [text]
        out: list[str] = []
        for part in parts:
            if part in self.special:
                out.append(" " + part)
            elif part:
                part = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")
                part = part.lower()
                # four control characters are white space to Python alone
                out += part.split() if not self.separators.search(part) else [x for x in self.spaces.split(part) if x]
        return out

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk without white space."""
        if chunk.isascii() or not self.odd.search(chunk):
            return self.words.findall(chunk)
        return self.words_with_odd.findall(chunk.translate(LOWER))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. Words and chunks that are new are encoded once."""
        split = [self.split(t) for t in texts]
        known = self.chunks
        parts = {c: [c] if c[0] == " " else self.pieces(c) for c in known.missing(set().union(*split))}
        words = self.cache.missing({w for c, ws in parts.items() if c[0] != " " for w in ws})
        short, rare = [w for w in words if len(w) <= CACHE_CHARS], dict[str, list[int]]()
        self.learn(short, self.cache)
        self.learn([w for w in words if len(w) > CACHE_CHARS], rare)
        long: dict[str, list[int]] = {}
        for c, ws in parts.items():
            ids = [self.special[c[1:]]] if c[0] == " " else [i for w in ws for i in (self.cache[w] if w in self.cache else rare[w])]
            (known if len(c) <= CACHE_CHARS else long)[c] = ids
        known.update(long)
        out = [list(chain.from_iterable(map(known.__getitem__, cs))) for cs in split]
        for c in long:
            del known[c]
        return out

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens are joined by one space."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of each row's whole text.

    ``tokenizer`` is the text of the JSON file, whose size is fixed, so it
    travels with the function. No shuffle: rows are encoded where they are
    read, in bounded batches. Null or empty text: no ids, empty string.
    Repeated rows are encoded as often as they come; no rows, no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(tokenizer)

        def out(keys: list, texts: list[str]) -> pa.RecordBatch:
            # nothing here refers to itself, and a search for such things walks all that is remembered
            gc.disable()
            try:
                ids = bpe.encode(texts)
            finally:
                gc.enable()
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(ids, pa.list_(pa.int32())), pa.array(map(bpe.decode, ids), pa.string())], names=["doc_id", "ids", "decoded"])

        for batch in batches:
            kind = batch.schema.field(0).type
            keys, texts, size = [], [], 0
            for row in range(batch.num_rows):
                keys.append(batch.column(0)[row].as_py())
                texts.append(batch.column(1)[row].as_py() or "")
                size += len(texts[-1])
                if len(texts) == BATCH_ROWS or size > BATCH_CHARS:
                    yield out(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield out(keys, texts)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
