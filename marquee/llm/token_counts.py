"""Token counts of a byte-level byte-pair vocabulary, by heap-and-linked-list merging; no identifiers are emitted.

A text is cut at the strings of the vocabulary's added tokens (one token each, the library's default), every stretch between them into
words by the byte-level pattern, and every word into its UTF-8 bytes as symbols of a doubly linked list. A heap holds the adjacent
pairs that the vocabulary merges; the pair of lowest rank, leftmost on ties, is popped and merged until no pair is left. A word's
count is its number of bytes minus its merges. Words repeat, so counts of short ones are kept in a dictionary of bounded size.

The pattern's classes of letters and numbers follow the library: its Unicode tables may be older or newer than the regex module's,
so every worker asks the library once for the class of each code point and texts with a differing one take a corrected pattern.

One Arrow pass over the text column, no shuffle; other columns stay in the JVM. The vocabulary file is a parameter that every worker reads
where it lies.

Edge cases: null and empty texts have 0 bytes and 0 tokens; a null id keeps its row; repeated rows give repeated results; there are no ties;
a text of any length is counted whole (words are taken from it a slice at a time beyond ``SLICE`` code points, and a word of any
length takes time n log n); an empty table gives an empty table; extra columns are ignored, whatever their names. Vocabularies that
normalise, add spaces, drop merges or are not byte-level pairs are refused.
"""
from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS, CACHE_CHARS, SLICE, LIMIT = 400_000, 64, 1 << 20, 1024
#: The byte-level pattern, with the places of its letter and number classes left open.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"
#: Code points that may be letters or numbers of some version of the tables.
PLANES = ((0, 0xD800), (0xE000, 0x40000))


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


def _ranges(points: list[int]) -> str:
    """A character class body of sorted code points."""
    out, at = [], 0
    while at < len(points):
        end = at
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out.append(f"\\U{points[at]:08X}-\\U{points[end]:08X}")
        at = end + 1
    return "".join(out)


def library_classes(tokenizer) -> tuple[list[int], list[int], list[int]]:
    """Code points whose class differs from the regex module's: (letters, numbers, neither) by the library."""
    import regex

    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    found: tuple[list[int], list[int], list[int]] = ([], [], [])
    for low, high in PLANES:
        for first in range(low, high, 1 << 14):
            points = range(first, min(high, first + (1 << 14)))
            # a letter joins the "a" before it, a number the "1" behind it
            cut = tokenizer.pre_tokenizer.pre_tokenize_str("".join(f"a{chr(p)}1" for p in points))
            starts = np.zeros(3 * len(points) + 1, bool)
            starts[[s for _, (s, _) in cut]] = True
            for i, p in enumerate(points):
                c = chr(p)
                if c == " ":  # goes with whatever follows it
                    continue
                own = 0 if letter.match(c) else 1 if number.match(c) else 2
                theirs = 0 if not starts[3 * i + 1] else 1 if not starts[3 * i + 2] else 2
                if own != theirs:
                    found[theirs].append(p)
    return found


class Counts(dict):
    """Word to number of tokens; forgets everything when full."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        n = self.count(word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n


class PairCounter:
    def __init__(self, tokenizer_file: str):
        import regex
        from tokenizers import Tokenizer

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if (model.get("type") != "BPE" or not plain or spec.get("normalizer") or cutter.get("type") != "ByteLevel"
                or cutter.get("add_prefix_space") or not cutter.get("use_regex", True)):
            raise ValueError("only byte-level byte-pair vocabularies without normaliser or prefix space are supported")
        added = [t for t in spec.get("added_tokens", ()) if t["content"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take spaces along or match whole words only are not supported")
        vocab = model["vocab"]
        symbols = byte_symbols()
        if any(s not in vocab for s in symbols):
            raise ValueError("the vocabulary lacks bytes")
        self.byte_id = [vocab[s] for s in symbols]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.pairs[vocab[a], vocab[b]] = rank, vocab[a + b]
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, strings))) if strings else None
        self.first = strings[0] if len(strings) == 1 else None
        letters, numbers, neither = library_classes(Tokenizer.from_file(tokenizer_file))
        plain_classes = {"L": r"\p{L}", "N": r"\p{N}", "l": r"\p{L}", "n": r"\p{N}"}
        self.words = regex.compile(self._fill(plain_classes))
        odd = sorted(letters + numbers + neither)
        self.odd = re.compile(f"[{_ranges(odd)}]") if odd else None
        less = f"--[{_ranges(odd)}]" if odd else ""
        named = {"L": rf"[[\p{{L}}{less}]{_ranges(letters)}]", "N": rf"[[\p{{N}}{less}]{_ranges(numbers)}]"}
        self.odd_words = regex.compile(self._fill({**named, "l": named["L"], "n": named["N"]}), regex.V1) if odd else self.words
        self.counts = Counts(self.count_word)

    @staticmethod
    def _fill(classes: dict[str, str]) -> str:
        return re.sub(r"\{([LNln])\}", lambda m: classes[m[1]], WORDS)

    def merges(self, sym: list[int]) -> int:
        """Number of merges of a list of symbols, which is used up."""
        n, pairs, done = len(sym), self.pairs, 0
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[p][0], i, p) for i, p in enumerate(zip(sym, sym[1:])) if p in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if sym[i] != pair[0] or j >= n or sym[j] != pair[1]:
                continue  # one of the two has been merged since
            sym[i], sym[j] = pairs[pair][1], -1
            done += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := (sym[i], sym[k])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], i, p))
            if (h := before[i]) >= 0 and (p := (sym[h], sym[i])) in pairs:
                heapq.heappush(heap, (pairs[p][0], h, p))
        return done

    def count_word(self, word: str) -> int:
        sym = [self.byte_id[b] for b in word.encode("utf-8", "surrogatepass")]
        return len(sym) - self.merges(sym) if len(sym) > 1 else len(sym)

    def _stretch(self, text: str) -> int:
        if not text:
            return 0
        words = self.odd_words if self.odd is not None and not text.isascii() and self.odd.search(text) else self.words
        get = self.counts.__getitem__
        if len(text) <= SLICE:
            return sum(map(get, words.findall(text)))
        total, found = 0, words.finditer(text)
        while part := [m[0] for m in islice(found, SLICE // 4)]:
            total += sum(map(get, part))
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.added is None or self.first is not None and self.first not in text:
            return self._stretch(text)
        total, at = 0, 0
        for m in self.added.finditer(text):
            total += self._stretch(text[at:m.start()]) + 1
            at = m.end()
        return total + self._stretch(text[at:])


@lru_cache(maxsize=2)
def counter(tokenizer_file: str) -> PairCounter:
    return PairCounter(tokenizer_file)


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        count = counter(tokenizer_file).count
        return pd.Series([count(t) if t else 0 for t in texts], dtype="int64")

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                       run(text).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
