"""Language ID by cross-parsing: the language in whose text a document falls into fewest phrases.

For each language, a suffix automaton holds all substrings of a bounded sample of its text. A document
is cut greedily into the longest phrases that the automaton knows. The counts are normalised by how
many phrases fresh text of each language needs, and the language with the smallest quotient wins.

Many stretches of text go through the automata side by side, one character a step, as rows of a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import slices, text_bytes

#: Documents of each language that the sample has on average, and characters taken of each.
SAMPLE_DOCS = 150
SAMPLE_CHARS = 400
#: Characters that one automaton holds at most.
TRAINING_CHARS = 40_000
#: A phrase never crosses a multiple of this many characters, so that stretches can be parsed side by
#: side. It adds less than one phrase to each, in every language.
STRETCH = 1_024
UNDETERMINED = "und"
#: How fast phrases a character fall with the length of the sample at most, as a power.
SLOPE = 0.4
#: Most frequent characters of each language that have a dense table, and cells of all tables. Steps by
#: other characters are looked up in sorted edges, which is slower and gives the same.
DENSE, DENSE_CELLS = 120, 1 << 26


def letter_table() -> np.ndarray:
    """For each code point: its lower-case code point if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
    return table


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = letter_table()
    return _letters


def folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, text): lower-cased letters with one blank (code 32) around each run of them."""
    data, offsets = text_bytes(column)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    starts_char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    owner = np.repeat(np.arange(len(column)), np.diff(starts_char[offsets]))
    low = letters()[codes]
    is_letter = low > 0
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    # of other characters, one stays after each run of letters
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1] & ~first[1:]
    return np.where(is_letter, low, 32)[keep], owner[keep]


@dataclass
class Automaton:
    """The suffix automaton of a symbol sequence. State 0 is the start."""

    symbols: list[int]

    def edges(self) -> tuple[int, np.ndarray]:
        """(number of states, rows of state, symbol and next state)."""
        longest, link, edges = [0], [-1], [{}]
        last = 0
        for c in self.symbols:
            new = len(longest)
            longest.append(longest[last] + 1)
            link.append(0)
            edges.append({})
            p = last
            while p != -1 and c not in edges[p]:
                edges[p][c] = new
                p = link[p]
            if p != -1:
                q = edges[p][c]
                if longest[p] + 1 == longest[q]:
                    link[new] = q
                else:
                    copy = len(longest)
                    longest.append(longest[p] + 1)
                    link.append(link[q])
                    edges.append(dict(edges[q]))
                    while p != -1 and edges[p].get(c) == q:
                        edges[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        rows = [(state, c, to) for state, out in enumerate(edges) for c, to in out.items()]
        return len(longest), np.array(rows, np.int64).reshape(-1, 3)


@dataclass
class Parser:
    """languages and, for each, the text it learns from and the phrases a character of fresh text needs.

    Only the text is sent to executors; each worker builds its automata once."""

    languages: list[str]
    texts: list[str]
    norms: list[float] = field(default_factory=list)

    def __getstate__(self):
        return {"languages": self.languages, "texts": self.texts, "norms": self.norms}

    @cached_property
    def classes(self) -> np.ndarray:
        """For each code point: its number in all samples together, 0 if unknown."""
        codes = np.unique(np.frombuffer("".join(self.texts).encode("utf-32-le"), np.uint32))
        table = np.zeros(0x110000, np.int32)
        table[codes] = np.arange(1, len(codes) + 1)
        return table

    @cached_property
    def automata(self) -> tuple[np.ndarray, ...]:
        """(dense table of all languages; keys and next states of the other edges; symbol of each character
        and next state from the start, by language; the start states).

        Each language numbers its own characters from 1 by falling frequency; 0 is one that it lacks."""
        known, many = int(self.classes.max()) + 1, len(self.texts)
        own, again = np.zeros((known, many), np.int32), np.full((known, many), -1, np.int32)
        starts, parts, base = [], [], 0
        for k, text in enumerate(self.texts):
            codes = self.classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
            found, counts = np.unique(codes, return_counts=True)
            own[found[np.argsort(-counts, kind="stable")], k] = np.arange(1, len(found) + 1)
            states, edges = Automaton(own[codes, k].tolist()).edges()
            first = edges[edges[:, 0] == 0]
            place = np.zeros(len(found) + 1, np.int64)
            place[own[found, k]] = found
            again[place[first[:, 1]], k] = first[:, 2] + base
            parts.append(edges + np.array([base, 0, base]))
            starts.append(base)
            base += states
        edges = np.concatenate([np.zeros((0, 3), np.int64), *parts])
        width = 1 + min(DENSE, DENSE_CELLS // max(1, base))
        dense = edges[:, 1] < width
        table = np.full((base, width), -1, np.int32)
        table[edges[dense, 0], edges[dense, 1]] = edges[dense, 2]
        keys = edges[~dense, 0] * known + edges[~dense, 1]
        order = np.argsort(keys)
        return (table, np.append(keys[order], np.int64(1 << 62)),
                np.append(edges[~dense, 2][order], -1).astype(np.int32), own, again, np.array(starts, np.int32))

    def phrases(self, codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """(texts, languages): the number of phrases of each text in each language."""
        table, keys, targets, own, again_of, roots = self.automata
        flat, width = table.ravel(), table.shape[1]
        column = np.where(own < width, own, 0)
        rare = (own >= width).any(axis=1)
        symbols = self.classes[codes].astype(np.int32)
        begin = np.searchsorted(owner, np.arange(n + 1))
        lengths = np.diff(begin)
        count = -(-lengths // STRETCH)
        text = np.repeat(np.arange(n), count)
        first = begin[text] + STRETCH * (
            np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        )
        size = np.minimum(begin[text + 1] - first, STRETCH)
        order = np.argsort(-size, kind="stable")
        first, size, text = first[order], size[order], text[order]
        state = np.tile(roots, (len(first), 1))
        found = np.zeros((len(first), len(roots)), np.int64)
        if len(first):
            alive = np.searchsorted(-size, -np.arange(int(size[0])), "left")
            for step, m in enumerate(alive.tolist()):
                c = symbols[first[:m] + step]
                to = flat[state[:m].astype(np.int64) * width + column[c]]
                some = np.flatnonzero(rare[c])
                if len(some):
                    of = own[c[some]]
                    key = state[some].astype(np.int64) * len(own) + of
                    at = np.searchsorted(keys, key)
                    to[some] = np.where(of < width, to[some], np.where(keys[at] == key, targets[at], -1))
                ended = to < 0
                found[:m] += ended
                again = again_of[c]
                to = np.where(ended, again, to)
                # A symbol that the language lacks is a phrase alone.
                lacking = to < 0
                found[:m] += lacking & (state[:m] != roots)
                state[:m] = np.where(lacking, roots, to)
            found += state != roots  # the phrase that is open at the end
        out = np.zeros((n, len(roots)), np.int64)
        np.add.at(out, text, found)
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text: see identify()."""
        codes, owner = folded(column)
        n = len(column)
        if not self.languages:
            return [UNDETERMINED] * n, np.zeros(n)
        cost = self.phrases(codes, owner, n) / np.array(self.norms)
        best = cost.argmin(axis=1)
        at = np.arange(n)
        least = cost[at, best]
        cost[at, best] = np.inf
        second = cost.min(axis=1) if cost.shape[1] > 1 else np.full(n, np.inf)
        empty = np.bincount(owner, minlength=n) == 0
        score = np.where(empty, 0.0, 1 - least / np.maximum(second, 1e-9))
        score = np.clip(score, 0.0, 1.0)
        return [UNDETERMINED if e else self.languages[b] for e, b in zip(empty, best)], score


def usual(norms: list[float], lengths: list[int]) -> list[float]:
    """The norm to expect of a sample of each length: a longer sample alone makes for fewer phrases.

    A line through the logarithms, falling by SLOPE at most. Norms are taken halfway to it: short texts
    should not be drawn to languages that parse badly."""
    if not norms:
        return []
    x, y = np.log(np.maximum(lengths, 1)), np.log(norms)
    x = x - x.mean()
    spread = float((x * x).sum())
    slope = float(np.clip((x * y).sum() / spread, -SLOPE, 0)) if spread > 1e-9 else 0.0
    return np.exp(y.mean() + slope * x).tolist()


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Parser:
    """A parser from labelled documents; rows with a null text or language are left out.

    A random sample of about SAMPLE_DOCS documents of each language is taken, SAMPLE_CHARS characters
    of each: half of a language's share teaches, up to TRAINING_CHARS, and a part of the rest gives the
    norm. The sample goes by a hash of the text and the row's other columns, the same in each run.
    """
    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = known.groupBy(F.col(lang).alias("_lang")).agg(F.count("*").alias("n"))
    draw = F.pmod(F.xxhash64(*docs.columns), F.lit(1 << 30)) / (1 << 30)
    start = F.pmod(F.xxhash64(F.col(text), F.lit("start")),
                   F.greatest(F.char_length(text) - SAMPLE_CHARS, F.lit(0)) + 1)
    rows = (
        known.withColumn("_draw", draw)
        .join(F.broadcast(counts), F.col(lang) == F.col("_lang"))
        .filter(F.col("_draw") * F.col("n") < SAMPLE_DOCS)
        .select(F.col(lang).alias("lang"), "_draw",
                F.substring(F.col(text), (start + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("part"))
        .distinct()  # equal rows are drawn together
        .collect()
    )
    parts: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["_draw"], r["part"])):
        codes, _ = folded(pa.array([row["part"]], pa.large_string()))
        if len(codes):
            parts.setdefault(row["lang"], []).append(codes.astype("<u4").tobytes().decode("utf-32-le"))
    parser = Parser([], [])
    fresh = []
    for language, texts in sorted(parts.items()):
        held = texts[4::5]
        taught = [t for i, t in enumerate(texts) if i % 5 != 4]
        parser.languages.append(language)
        # Without any to hold out, each document in turn is fresh to the others; one alone, half by half.
        if held:
            fresh.append([(taught, held)])
        else:
            half = len(texts[0]) // 2
            turns = texts if len(texts) > 1 else [t for t in (texts[0][:half], texts[0][half:]) if t]
            fresh.append([(turns[:i] + turns[i + 1 :], [t]) for i, t in enumerate(turns)])
        parser.texts.append(" ".join(taught)[:TRAINING_CHARS])
    raw = []
    for turns in fresh:
        own = size = 0
        for known, texts in turns:
            codes, owner = folded(pa.array(texts, pa.large_string()))
            alone = Parser([""], [" ".join(known)[:TRAINING_CHARS]])
            own += int(alone.phrases(codes, owner, len(texts)).sum())
            size += len(codes)
        raw.append(max(own, 1) / max(1, size))
    parser.norms = [(x + y) / 2 for x, y in zip(raw, usual(raw, list(map(len, parser.texts))))]
    return parser


def identify(docs: DataFrame, parser: Parser, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1); columns of these names are replaced.

    score is by what part the winner needs fewer phrases than the next language. Ties go to the first
    language by name. A null text, or one without letters, is `und` with score 0; so is every text if
    nothing was learned. Whole texts are parsed. Repeated rows get equal results, null ids and further
    columns do no harm, an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in columns:
            names, scores = [], []
            for part in slices(column):
                name, score = own.predict(part)
                names += name
                scores += score.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    rows = docs.withColumn("_language", predicted(F.col(text)))
    return rows.withColumns({"lang_pred": F.col("_language.lang_pred"), "score": F.col("_language.score")}).drop("_language")


def is_held_out(id: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text divides by folds; null ids are held out."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % folds == 0, F.lit(True))
