"""Each operator against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import plain
from ticketmill.llm import (
    chat,
    decontam,
    graph,
    language,
    packing,
    pages,
    passages,
    queries,
    rules,
    simhash,
    storage,
    tokens,
    toxicity,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, some of them under a null id and some rows twice, with a column that clashes."""
    rows = [(i, t, "x") for i, t in enumerate(plain.ODD_TEXTS)]
    rows += [(None, t, None) for t in plain.ODD_TEXTS[:5]] + rows[3:6]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- packing


def check_packing(frame, docs, tokenizer, capacity=1024):
    found = frame.collect()
    by_doc = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    assert by_doc == Counter(
        (doc, *p) for doc, text in docs for p in plain.pieces(tokenizer, text, capacity)
    )
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for sequence in places.values():
        end = 0
        for offset, length in sorted(sequence):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places), sum(r["length"] for r in found)


def test_packing(spark, odd, none, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    check_packing(packing.pack(odd, BYTES, RANKS), rows_of(odd), tokenizer)
    check_packing(packing.pack(odd, BYTES, RANKS, capacity=7), rows_of(odd), tokenizer, 7)
    bins, total = check_packing(packing.pack(documents, BYTES, RANKS), rows_of(documents), tokenizer)
    assert bins <= -(-total // 1024) * 1.01 + 1
    assert packing.pack(none, BYTES, RANKS).count() == 0
    with_ids = packing.pack(odd, BYTES, RANKS, ids=True).filter("piece = 0 AND doc_id = 4").first()
    assert with_ids["ids"] == [*tokenizer.encode("a").ids, 2]


def smallest(counts, capacity):
    """The least number of bins, by trying everything."""
    lengths = sorted(Counter(counts).elements(), reverse=True)
    best = len(lengths)

    def place(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(lengths):
            best = len(free)
            return
        for k in {f: k for k, f in enumerate(free) if f >= lengths[i]}.values():
            place(i + 1, [*free[:k], free[k] - lengths[i], *free[k + 1 :]])
        place(i + 1, [*free, capacity - lengths[i]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_inputs():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.randint(5, 30)
        counts = dict(Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 10))))
        plan = packing.bin_completion(counts, capacity)
        held = Counter()
        for lengths, n in plan:
            assert sum(lengths) <= capacity
            held.update({x: k * n for x, k in Counter(lengths).items()})
        assert held == Counter(counts)
        assert packing.n_bins(plan) == smallest(counts, capacity)


def test_bin_completion_beats_best_fit_on_the_given_documents():
    texts = pq.read_table(f"{SF}/../sf0.01/documents.parquet", columns=["text"])["text"].combine_chunks()
    counts = Counter()
    for part in packing.slices(texts):
        cut = packing.pieces(part, 1024, BYTES, RANKS, False)
        counts.update(cut.flatten().field("length").to_pylist())
    plan = packing.bin_completion(counts, 1024)
    held = Counter()
    for lengths, n in plan:
        assert sum(lengths) <= 1024 and n > 0
        held.update({x: k * n for x, k in Counter(lengths).items()})
    assert held == counts
    assert packing.n_bins(plan) < packing.n_bins(packing.best_fit(counts, 1024))
    assert packing.n_bins(plan) <= packing.least_bins(counts, 1024) + 1


def test_least_bins_is_no_more_than_the_least():
    rng = random.Random(9)
    for _ in range(60):
        capacity = rng.randint(5, 30)
        counts = dict(Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 10))))
        assert packing.waste_bound(counts, capacity) <= packing.least_bins(counts, capacity)
        assert packing.least_bins(counts, capacity) <= smallest(counts, capacity)
    assert packing.least_bins({7: 3, 5: 3, 4: 3}, 10) > packing.waste_bound({7: 3, 5: 3, 4: 3}, 10)


def test_bin_completion_of_many_equal_lengths():
    plan = packing.bin_completion({600: 10**6, 400: 10**6, 24: 10**6, 1: 3})
    assert packing.n_bins(plan) == 10**6 + 1


# ---------------------------------------------------------------- language


def test_parse_equals_brute_force():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc ") for _ in range(60)), "".join(rng.choice("bcd ") for _ in range(60))]
    parser = language.Parser(["x", "y"], texts, [1.0, 1.0])
    docs = ["".join(rng.choice("abcde ") for _ in range(n)) for n in (0, 1, 5, 50, 200)]
    codes = [np.frombuffer(d.encode("utf-32-le"), np.uint32) for d in docs]
    owner = np.repeat(np.arange(len(docs)), [len(c) for c in codes])
    found = parser.phrases(np.concatenate(codes), owner, len(docs))
    for i, doc in enumerate(docs):
        for k, known in enumerate(texts):
            assert found[i, k] == plain.cross_parse(doc, known), (doc, known)


def test_languages_of_many_characters_keep_all_of_them():
    """Beside each other: languages of 60 to 900 letters, on dense tables and on sorted edges."""
    rng = random.Random(17)
    scripts = [range(0x4E00, 0x4E00 + 900), range(0xAC00, 0xAC00 + 700), range(0x3041, 0x3041 + 80), range(97, 123)]
    texts = ["".join(chr(rng.choice(s)) for _ in range(3000)) for s in scripts]
    parser = language.Parser(["zh", "ko", "ja", "en"], texts, [1.0] * 4)
    docs = [t[i : i + 60] + "".join(chr(rng.choice(s)) for _ in range(20)) for t, s in zip(texts, scripts) for i in (0, 900)]
    codes = [np.frombuffer(d.encode("utf-32-le"), np.uint32) for d in docs]
    found = parser.phrases(np.concatenate(codes), np.repeat(np.arange(len(docs)), [len(c) for c in codes]), len(docs))
    for i, doc in enumerate(docs):
        assert found[i].tolist() == [plain.cross_parse(doc, known) for known in texts]
        assert found[i].argmin() == i // 2


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.is_held_out(F.col("doc_id")))
    parser = language.train(docs.filter("NOT held_out"))
    found = language.identify(docs.filter("held_out"), parser).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) > 0.98 * len(found) > 100
    assert all(0 <= r["score"] <= 1 for r in found)


def test_a_language_of_three_documents_leaves_the_others_whole(spark):
    rng = random.Random(18)
    stems = {k: words_of(rng, 300) for k in ("aa", "bb", "cc")}
    def rows(k, n):
        return [(k, " ".join(rng.choice(stems[k]) for _ in range(80))) for _ in range(n)]
    learned = rows("aa", 150) + rows("bb", 150) + rows("cc", 3)
    parser = language.train(spark.createDataFrame(learned, "lang string, text string"))
    size = dict(zip(parser.languages, map(len, parser.texts)))
    assert size["cc"] < 2_000 and size["aa"] > 30_000 < size["bb"]
    fresh = spark.createDataFrame(rows("aa", 40) + rows("bb", 40) + rows("cc", 40), "lang string, text string")
    found = Counter((r["lang"], r["lang_pred"]) for r in language.identify(fresh, parser).collect())
    assert all(found[k, k] >= 38 for k in stems), found


def test_language_of_odd_texts(spark, odd, none):
    parser = language.Parser(["x"], ["abc abc"], [1.0])
    for r in language.identify(odd, parser).collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != "und") == letters
    assert language.identify(none, parser).count() == 0
    nothing = language.train(none.withColumn("lang", F.lit("x")))
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}


# ---------------------------------------------------------------- pages


def test_pages(spark):
    rows = spark.read.parquet(f"{SF}/../sf0.01/pages.parquet")
    model = pages.train(rows)
    import html
    import re

    for r in pages.extract(rows, model).collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1)>", "\0", article.replace("<br>", " "))).split("\0")
        wanted = "\n".join(" ".join(html.unescape(b).split()) for b in blocks if b.split())
        assert (r["text"], r["n_chars"]) == (wanted, len(wanted))

    def text(page):
        made = spark.createDataFrame([(page, 1, "other")], "html string, n_chars int, text string")
        return pages.extract(made, model).first()["text"]

    for empty in (None, "", "<script>x", "<!-- open", "<nav><ul><li><a href=a>One</a></ul></nav>"):
        assert text(empty) == ""
    body = "".join(f"<p>A sentence of some length &amp; with&nbsp;words,\n number {i}.</p>" for i in range(6))
    page = (
        "<body><div class=menu><ul><li><a href=a>Home</a><li><a href=b>More</a></ul></div>"
        f"<div class=content><h1>Title</h1>{body}<div class=ad><p>Buy this now</p></div></div>"
        "<div id=comments><h3>Comments</h3><div class=comment><p>I do not agree with it</p></div></div>"
        "<footer>&copy; all</footer></body>"
    )
    lines = [f"A sentence of some length & with words, number {i}." for i in range(6)]
    assert text(page).split("\n") == ["Title", *lines]


def test_decoding_never_returns_to_the_article():
    tree = pages.parse("<article><div><p>in</p></div></article>")
    assert tree.tag[1:] == ["article", "div", "p"]
    assert pages.decode(tree, np.array([-9.0, 5.0, -1.0, 3.0])) == [False, True, True, True]
    assert pages.decode(tree, np.array([-9.0, 5.0, -9.0, 0.1])) == [False, True, False, False]


def all_text(page):
    """The text of a page of which everything is taken."""
    tree = pages.parse(page)
    return pages.block_text(tree, [True] * len(tree.tag))


def test_formulas_drawings_and_objects_keep_their_text():
    assert all_text("<p>one <math>x=2</math> two</p>") == "one x=2 two"
    assert all_text("<p>one <math><mi>x</mi><mo>=</mo><mn>2</mn></math> two") == "one x=2 two"
    assert all_text("<p>a <object data=f>shown instead</object> b</p>") == "a shown instead b"
    assert all_text("<p>one</p><svg><path d=1><p>two</p></article>") == "one\ntwo"
    assert all_text("<p>one</p><math><mi>x<p>two</p>") == "one\nx\ntwo"
    assert all_text("<p>one</p><select><option>x<p>two</p>").split("\n")[-1] == "two"
    assert all_text("<p>one</p><object><p>two</p>") == "one\ntwo"
    assert all_text("<p>one</p><select><option>x</option></select><p>two</p>") == "one\ntwo"
    assert all_text("<p>one</p><script>x = '<p>two</p>'") == "one"
    assert all_text("a < b <3 <a 'open <b>c</b>") == "a < b <3 <a 'open c"


@pytest.mark.parametrize("part", ["<a '", "<a \"'", "<a", "<!", "<object>", "<svg>", "<select>", "<b></x>", "<span></b>"])
def test_broken_pages_are_parsed_in_time_that_follows_their_length(part):
    begin = time.process_time()
    for tail in ("", '">'):
        pages.parse("<b><div>" + part * ((1 << 20) // len(part)) + tail)
    assert time.process_time() - begin < 30


def test_decoding_against_all_labels_of_small_trees():
    rng = random.Random(31)
    further = {0: (0, 1), 1: (1, 2), 2: (2,)}
    for _ in range(80):
        n = rng.randint(2, 8)
        tree = pages.Tree([""] * n, [-1, *(rng.randrange(i) for i in range(1, n))], [0] * n, [None] * n,
                          [rng.choice([0, 0, 3, 50]) for _ in range(n)], [0] * n, [])
        logits = np.array([rng.gauss(0, 2) for _ in range(n)])
        weight = 1 + np.log1p(np.array(tree.own, float))
        score = np.stack([-np.logaddexp(0, logits), -np.logaddexp(0, -logits)]) * weight

        def value(labels):
            return sum(score[int(x), i] for i, x in enumerate(labels) if i)

        best = max(
            value([s == 1 for s in states])
            for states in itertools.product((0, 1, 2), repeat=n)
            if states[0] == 0 and all(states[i] in further[states[tree.parent[i]]] for i in range(1, n))
        )
        assert value(pages.decode(tree, logits)) == pytest.approx(best)


def test_boosted_trees_against_plain_boosting(monkeypatch):
    monkeypatch.setattr(pages, "TREES", 5)
    monkeypatch.setattr(pages, "DEPTH", 2)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 3))
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=60) > 0.5).astype(float)
    weight = rng.choice([1.0, 6.0], 60)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, pages.BINS + 1)[1:-1])) for c in x.T]
    logit = np.full(60, np.log(y.mean() / (1 - y.mean())))
    for _ in range(5):
        p = 1 / (1 + np.exp(-logit))
        g, h = weight * (y - p), weight * p * (1 - p)

        def part(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + pages.SHRINK)

        def grow(rows, depth):
            if depth == 2:
                logit[rows] += pages.RATE * g[rows].sum() / (h[rows].sum() + pages.SHRINK)
                return
            gain, f, c = max(
                (part(rows[x[rows, f] <= c]) + part(rows[x[rows, f] > c]) - part(rows), f, c)
                for f in range(3) for c in cuts[f]
            )
            low = x[rows, f] <= c if gain > pages.LEAST_GAIN else np.ones(len(rows), bool)
            grow(rows[low], depth + 1)
            grow(rows[~low], depth + 1)

        grow(np.arange(60), 0)
    assert pages.boost(x, y, weight).logits(x) == pytest.approx(logit)


def test_pages_of_an_empty_table(spark):
    none = spark.createDataFrame([], "page_id bigint, html string, text int")
    model = pages.train(none)
    assert pages.extract(none, model).count() == 0
    some = spark.createDataFrame([(1, None), (2, "")], "page_id bigint, html string")
    assert {(r["text"], r["n_chars"]) for r in pages.extract(some, model).collect()} == {("", 0)}


# ---------------------------------------------------------------- chat


def test_chat_round_trip(spark):
    marks = ["</s>", "<\\/s>", "<\\\\/s>", "[INST]", "[\\/INST]", "[/INST]</s>", "<", "[", "\\", "<s>"]
    texts = [*plain.ODD_TEXTS[:-1], *marks, "".join(marks)]
    rows = [(i // 3, i % 3, ("user", "assistant", None)[i % 3], t) for i, t in enumerate(texts)]
    rows += [(None, 0, "assistant", "no id"), (0, 1, "assistant", "tie"), rows[4]]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = chat.format_turns(turns, RANKS)
    for r in chat.read_turns(made, RANKS).collect():
        text = r["text"] or ""
        trained = text if r["role"] == "assistant" else ""
        assert (r["read"]["role"], r["read"]["text"]) == (r["role"] or "", text)
        assert r["read"]["loss_text"] == trained
        assert sum(i in chat.MARKS for i in r["ids"]) == 3
    found = {r["conv_id"]: r for r in chat.digests(made, RANKS).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or "", text or ""))
    assert found.keys() == by.keys()
    for conv, own in by.items():
        own.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = found[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_turns(turns.filter("false"), RANKS), RANKS).count() == 0


# ---------------------------------------------------------------- tokens


def test_token_counts(spark, odd, none, documents):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    for frame in (odd, documents):
        for r in tokens.count_tokens(frame, PIECES).collect():
            text = r["text"] or ""
            assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(model.encode(text)))
    assert tokens.count_tokens(odd, PIECES).count() == odd.count()
    assert tokens.count_tokens(none, PIECES).count() == 0


def test_token_counts_of_random_blanks():
    model = tokens.piece_model(PIECES)
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  \n▁é") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    assert tokens.piece_counts(pa.array(texts), model).tolist() == [len(model.encode(t)) for t in texts]


# ---------------------------------------------------------------- decontamination


def test_search_equals_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        vocabulary = ["a", "B", "c9", "é", "dd"][: rng.randint(1, 5)]

        def text(n):
            return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(n)))

        texts = [rng.choice([None, "", text(40), text(40), text(5)]) for _ in range(rng.randrange(6))]
        items = [(str(i), rng.choice([text(14), text(4)])) for i in range(rng.randrange(5))]
        column = pa.array(texts, pa.string())

        def phrases(some):
            return decontam.Phrases.of([n for n, _ in some], [t for _, t in some])

        def plainly(found):
            return [(r["n_words"], r["n_hit"], set(r["items"])) for r in found.to_pylist()]

        found = decontam.searched(column, None, phrases(items))
        assert plainly(found) == plain.hits(texts, items)
        half = decontam.searched(column, None, phrases(items[: len(items) // 2]))
        assert plainly(decontam.searched(column, half, phrases(items[len(items) // 2 :]))) == plainly(found)


def test_contamination(spark, odd, none, monkeypatch):
    items = [(1, "lead and TRAIL"), (2, "one two three one two three one two three one"), (2, "same line"),
             (None, "日本"), (3, None), (4, "")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    named = [(None if n is None else str(n), t) for n, t in items]
    wanted = Counter(
        (doc, n, hit, frozenset(found))
        for (doc, _), (n, hit, found) in zip(rows_of(odd), plain.hits([t for _, t in rows_of(odd)], named))
    )
    for block in (1 << 20, 8):  # in one turn, and in several
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        found = decontam.contamination(odd, benchmark).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_hit"], frozenset(r["items"])) for r in found) == wanted
    clean = {r["doc_id"]: r["clean_text"] for r in found}
    assert (clean[3], clean[6], clean[9], clean[11]) == ("\n\n", "  ", "", " 語")
    assert decontam.contamination(none, benchmark).count() == 0
    untouched = decontam.contamination(odd, benchmark.filter("false"))
    assert untouched.filter("n_hit > 0 OR NOT (text <=> clean_text)").count() == 0


# ---------------------------------------------------------------- passages


def words_of(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 8))) for _ in range(n)]


def test_passages(spark, none):
    rng = random.Random(2)
    docs = {i: words_of(rng, rng.randint(0, 300)) for i in range(30)}
    exact, fuzzy, short = words_of(rng, 80), words_of(rng, 70), words_of(rng, 40)
    changed = [w for i, w in enumerate(fuzzy) if i != 40]
    for i in (12, 30, 55):
        changed[i] = "zz"
    at = {}
    for i, passage in ((3, exact), (7, exact), (9, exact), (4, fuzzy), (25, changed), (5, short), (6, short)):
        at[i] = rng.randint(0, len(docs[i]))
        docs[i][at[i] : at[i]] = passage
    docs[27] = list(docs[26])
    rows = [(i, " ".join(w)) for i, w in docs.items()]
    rows += [(None, "  ".join(docs[26])), (100, None), (101, ""), rows[3]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("words", F.lit(1))
    found = {r["doc_id"]: r for r in passages.passages(frame).collect()}
    assert found.keys() == {7, 9, 25, 27, None}
    for i in (7, 9):
        r = found[i]
        assert (r["first_word"], r["n_words"], r["source_ids"]) == (at[i], 80, [3])
    assert found[25]["source_ids"] == [4] and found[25]["n_words"] == 69
    assert found[27]["n_words"] == len(docs[26]) == found[None]["n_words"]
    left = {}
    for r in passages.without_passages(frame).collect():
        left.setdefault(r["doc_id"], []).append(r["text"])
    assert left[3] == [rows[3][1]] * 2
    assert left[7][0].split() == docs[7][: at[7]] + docs[7][at[7] + 80 :]
    assert None not in left and 27 not in left and left[100] == [None] and left[101] == [""]
    assert all(left[i] == [rows[i][1]] for i in range(27) if i not in (3, 7, 9, 25))
    assert passages.passages(none).count() == 0
    assert passages.without_passages(none).count() == 0


def test_a_passage_of_all_documents_gives_one_match_for_each(spark):
    rng = random.Random(8)
    common = words_of(rng, 60)
    rows = [(i, " ".join(words_of(rng, 20) + common + words_of(rng, 20))) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = passages.passages(frame).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(1, 200))
    assert all((r["first_word"], r["n_words"]) == (20, 60) and 0 in r["source_ids"] for r in found)


def found_in(spark, docs):
    """Documents by number, and the words that passages() finds repeated in each."""
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id bigint, text string")
    out = defaultdict(set)
    for r in passages.passages(frame).collect():
        out[r["doc_id"]] |= set(range(r["first_word"], r["last_word"] + 1))
    return out


def recall(spark, edited, n=40):
    """How many of n passages of 60 words are found whole (but for an edit at an end) in edited copies."""
    rng = random.Random(11)
    originals, copies, at = [], [], []
    for _ in range(n):
        passage = words_of(rng, 60)
        changed = edited(rng, passage)
        originals.append(words_of(rng, 100) + passage + words_of(rng, 100))
        copies.append(words_of(rng, 90) + changed + words_of(rng, 90))
        at.append(set(range(90, 90 + len(changed))))
    found = found_in(spark, originals + copies)
    assert all(i >= n for i in found)
    return sum(len(found[n + i] & at[i]) >= 0.9 * len(at[i]) for i in range(n))


@pytest.mark.parametrize("every, least", [(20, 40), (10, 40), (8, 40), (7, 40), (6, 39), (5, 38)])
def test_fuzzy_passages_are_found(spark, every, least):
    """One word replaced every so many: similarity 0.95 to 0.80."""
    def edited(rng, passage):
        return [w if i % every != every // 2 else f"x{rng.random()}" for i, w in enumerate(passage)]

    assert recall(spark, edited) >= least


def test_alike_parts_of_an_unlike_chain_stay(spark):
    """Exact passages of 50 words; after them, unlike words and a further shared run, short or long."""
    rng = random.Random(13)
    originals, copies, wanted = [], [], []
    for gap, more in ((20, 5), (26, 50), (28, 50), (30, 50)):
        for _ in range(5):
            exact, further = words_of(rng, 50), words_of(rng, more)
            originals.append(words_of(rng, 60) + exact + words_of(rng, gap) + further + words_of(rng, 60))
            copies.append(words_of(rng, 70) + exact + words_of(rng, gap) + further + words_of(rng, 70))
            wanted.append(set(range(70, 120)) | (set(range(120 + gap, 170 + gap)) if more == 50 else set()))
    found = found_in(spark, originals + copies)
    assert [found[20 + i] for i in range(20)] == wanted


@pytest.mark.parametrize("n_words, n", [(n, k) for n in (60, 100) for k in (5, 8, 9, 12)])
def test_insertions_and_deletions_inside_passages(n_words, n):
    """Chaining and alignment decide, not a fixed shift: one edit of n words in the middle."""
    rng = random.Random(14)
    words = [rng.randint(-(1 << 31), 1 << 31) for _ in range(n_words)]
    half = n_words // 2
    longer = words[:half] + [rng.randint(-(1 << 31), 1 << 31) for _ in range(n)] + words[half:]
    shift = {i: i if i < half else i + n for i in range(n_words)}
    at = [i for i in range(0, n_words - 3, 3) if shift[i + 3] == shift[i] + 3]
    for a, b, xs, ys in (
        (words, longer, at, [shift[i] for i in at]), (longer, words, [shift[i] for i in at], at),
    ):
        got = []
        for c in passages.chains(xs, ys):
            x, y = (np.array([v[k] for k in c]) for v in (xs, ys))
            got += passages.aligned(np.array(a), np.array(b), x, y, 0.8)
        assert got == [(0, len(a), 0, len(b), n)]


def test_links_go_to_first_and_last_places_in_earlier_documents():
    rng = random.Random(15)
    rows = sorted({(rng.randint(0, 8), rng.randint(0, 12), rng.randint(0, 5)) for _ in range(300)})
    for size in (1, 2, 7, 300):
        batches = [
            pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size])], ["hash", "doc", "at"])
            for i in range(0, len(rows), size)
        ]
        got = Counter(tuple(r.values()) for b in passages.linked(iter(batches)) for r in b.to_pylist())
        wanted = Counter()
        for h, doc, at in rows:
            earlier = [r[1:] for r in rows if r[0] == h and r[1] < doc]
            wanted.update((doc, at, *e) for e in {*earlier[:1], *earlier[-passages.PREVIOUS :]})
        assert got == wanted


def test_matches_that_may_grow_to_a_span_stay():
    """The bits around two seeds never tell less than growth over the words themselves; most chance matches go."""
    rng = random.Random(20)
    near, side = passages.AROUND, 20

    def some(n):
        return [rng.getrandbits(64) for _ in range(n)]

    def edited(words, share):
        out = []
        for w in words:
            kind = rng.random()
            out += [w] if kind > share else [] if kind < share / 4 else some(1) if kind < share * 3 / 4 else [w, *some(1)]
        return (out + some(side))[:side]

    def bits(before, after):
        n = rng.randint(0, side)  # the text ends there
        words = np.array([*some(3), *before[::-1], 1, 2, 3, 4, *after[:n], *some(2)], np.uint64)
        owner = np.repeat([0, 1, 2], [3, side + 4 + n, 2])
        return passages.around(words, owner, np.array([3 + side]))[0], after[:n]

    rows, able = [], []
    for _ in range(3000):
        share = rng.choice([0, 0.1, 0.2, 0.3, 0.5, 1])
        before, after = some(side), some(side)
        others = edited(before, share), edited(after, share)
        (a, right), (b, other_right) = bits(before, after), bits(*others)
        rows.append((a, b))
        grown = [passages.grown(x[:near], y[:near], passages.EDIT_COST)[0]
                 for x, y in ((before, others[0]), (right, other_right))]
        able.append(sum(grown) >= passages.SPAN_WORDS - passages.SEED_WORDS)
    a, b = np.array(rows).T
    got = passages.may_span(a, b)
    assert got[np.array(able)].all()
    assert passages.may_span(np.zeros(1, np.int64), np.zeros(1, np.int64)).all()  # long seeds
    chance = passages.may_span(a, np.roll(a, 1))
    assert chance.mean() < 0.15


def test_links_of_seeds_in_unlike_words_go():
    same, other = 0o1234567012345670, 0o7654321076543217
    rows = [(5, 1, 10, same), (5, 2, 20, other), (5, 3, 30, same), (6, 4, 1, 0), (6, 5, 1, 0)]
    for size in (1, 2, 5):
        batches = [
            pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size])], ["hash", "doc", "at", "around"])
            for i in range(0, len(rows), size)
        ]
        got = sorted(tuple(r.values()) for b in passages.linked(iter(batches)) for r in b.to_pylist())
        assert got == [(3, 30, 1, 10), (5, 1, 4, 1)]


@pytest.mark.parametrize("times", [1, 8])
def test_passages_of_phrases_that_other_documents_have(spark, times):
    """Every run of five words of a passage stands also in some unrelated documents before and between."""
    rng = random.Random(16)
    shared = [words_of(rng, 60) for _ in range(10)]

    def scattered():
        runs = [p[i : i + 6] for p in shared for i in range(0, 55, 2)]
        rng.shuffle(runs)
        return [sum((r + words_of(rng, 6) for r in runs[k::10]), []) for k in range(10)]

    def around():
        return [words_of(rng, 20) + p + words_of(rng, 20) for p in shared]

    before = sum((scattered() for _ in range(times)), [])
    between = sum((scattered() for _ in range(times)), [])
    found = found_in(spark, before + around() + between + around())
    last = len(before) + 10 + len(between)
    assert {i: w for i, w in found.items() if w} == {last + i: set(range(20, 80)) for i in range(10)}


def further_than_others(rows):
    """All links that linked() may not leave out, by comparing each row with all before it."""
    wanted = set()
    for h, doc, at, *bits in rows:
        earlier = [r for r in rows if r[0] == h and r[1] < doc]
        copy = next((r for r in earlier if r[3:] == tuple(bits)), None)
        reached = []
        for r in [copy] if copy else earlier:
            before, after = (int(x[0]) for x in passages.reaches(*((np.array([a]), np.array([b])) for a, b in zip(bits, r[3:]))))
            if (before + after >= 8 or bits[1] >= passages.LONG) and not any(x >= before and y >= after for x, y in reached):
                wanted.add((doc, at, r[1], r[2]))
                reached.append((before, after))
    return wanted


def test_no_earlier_place_of_a_seed_is_left_out_that_reaches_further(monkeypatch):
    rng = random.Random(24)
    rows = []
    for h in range(12):
        kinds = [[rng.randint(0, 7) for _ in range(16)] for _ in range(6)]
        for _ in range(60):
            words = list(rng.choice(kinds))
            for _ in range(rng.choice([0, 1, 2, 4])):
                words[rng.randrange(16)] = rng.randint(0, 7)
            near = sum(w << 3 * i for i, w in enumerate(words))
            rows.append((h, rng.randint(0, 50), 10 * h + rng.randint(0, 9), near, near ^ (passages.LONG if h % 3 == 0 else 0)))
    rows = sorted({r[:3]: r for r in rows}.values())
    wanted = further_than_others(rows)
    for size, pairs in ((1, 1 << 17), (50, 7), (1000, 100), (1000, 1 << 17)):
        monkeypatch.setattr(passages, "PAIRS", pairs)
        batches = [
            pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size])],
                            ["hash", "doc", "at", "around", "further"])
            for i in range(0, len(rows), size)
        ]
        got = [tuple(r.values()) for b in passages.linked(iter(batches)) for r in b.to_pylist()]
        assert len(got) == len(set(got)) and wanted <= set(got)
        assert len(got) < len(rows) * 12  # but not with all


def test_places_that_can_be_linked_are_looked_up(monkeypatch):
    """Seeds with equal words on no side, on one side, and in edited copies, short and long: all links that comparing
    each place with all earlier ones gives, from a fraction of the pairs."""
    rng = random.Random(27)
    rows = []
    for h in range(8):
        copied = [rng.getrandbits(6) for _ in range(16)]
        for doc in range(700):
            words = [rng.getrandbits(6) for _ in range(16)]
            if h % 4 == 1:
                words[8:] = copied[8:]
            if h % 4 == 2:
                words[:8] = copied[:8]
            if h % 4 == 3:
                words = list(copied)
                for _ in range(rng.randrange(8)):
                    at = rng.randrange(16)
                    change = rng.choice([[], [rng.getrandbits(6)], [words[at], rng.getrandbits(6)]])
                    words = (words[:at] + change + words[at + 1 :] + [rng.getrandbits(6)])[:16]
            near, far = (sum((w >> k & 7) << 3 * i for i, w in enumerate(words)) for k in (0, 3))
            rows.append((h, doc, 10, near, far | (passages.LONG if h > 3 else 0)))
    counted, plain_reaches = [], passages.reaches

    def counting(*bits):
        counted.append(len(bits[0][0]))
        return plain_reaches(*bits)

    def links(size):
        batches = [
            pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size])],
                            ["hash", "doc", "at", "around", "further"])
            for i in range(0, len(rows), size)
        ]
        counted.clear()
        return sorted(tuple(r.values()) for b in passages.linked(iter(batches)) for r in b.to_pylist())

    monkeypatch.setattr(passages, "reaches", counting)
    found = links(1000)
    assert sum(counted) < 8 * 700 * 700 / 2 / 2
    monkeypatch.setattr(passages, "LOOKED_UP", 1 << 40)
    assert found == links(1000)
    assert sum(counted) > 8 * 700 * 700 / 2 / 2
    monkeypatch.setattr(passages, "LOOKED_UP", 0)
    for size, pairs in ((1000, 1 << 17), (300, 50)):
        monkeypatch.setattr(passages, "PAIRS", pairs)
        assert found == links(size)


def test_few_places_of_a_seed_at_the_end_of_a_common_line_are_compared(monkeypatch):
    """All words on one side of a seed are the same everywhere, and the first four on the other: of 6,000 places, a row is
    compared with 200 at most in the mean, and all links are there that comparing each with all earlier ones gives."""
    counted, plain_reaches = [], passages.reaches

    def counting(*bits):
        counted.append(len(bits[0][0]))
        return plain_reaches(*bits)

    def links(side, n, long):
        rng = random.Random(28)
        line, rows = [rng.getrandbits(6) for _ in range(12)], []
        for doc in range(n):
            words = [[*line[:4], *(rng.getrandbits(6) for _ in range(4))], line[4:]]
            words = words[side] + words[1 - side]
            near, far = (sum((w >> k & 7) << 3 * i for i, w in enumerate(words)) for k in (0, 3))
            rows.append((5, doc, 10, near, far | long))
        batch = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], ["hash", "doc", "at", "around", "further"])
        counted.clear()
        return [tuple(r.values()) for b in passages.linked(iter([batch])) for r in b.to_pylist()]

    monkeypatch.setattr(passages, "reaches", counting)
    for side in (0, 1):
        for long in (0, passages.LONG):
            links(side, 6000, long)
            assert sum(counted) < 200 * 6000
            found = links(side, 1500, long)
            with monkeypatch.context() as plain:
                plain.setattr(passages, "LOOKED_UP", 1 << 40)
                assert found == links(side, 1500, long)


def test_words_that_are_looked_up_are_part_of_every_reach():
    """Whatever reach() finds of few different words, one of the sets of words looked up for it or less is shared."""
    rng = np.random.default_rng(29)
    a, b = (rng.integers(0, 2, (4000, passages.AROUND)) for _ in range(2))
    codes = [(x << 3 * np.arange(passages.AROUND)).sum(axis=1) for x in (a, b)]
    got = passages.reach(*codes)
    assert set(got.tolist()) >= {0, 1, 3, 8}
    for level in range(1, passages.AROUND + 1):
        for words in range(2, 7):
            some = np.zeros(len(a), bool)
            for pairs in passages.shared(level, words):
                assert 0 < len(pairs) <= words
                some |= np.all([a[:, i] == b[:, i - shift] for i, shift in pairs], axis=0)
            assert some[got >= level].all()


def test_a_place_between_the_first_and_the_last_is_found():
    """Of twelve documents with a seed, the sixth has the words around it that the last has."""
    rng = random.Random(25)
    bits = [rng.getrandbits(48) for _ in range(11)]
    rows = [(5, doc, 10, b, b) for doc, b in enumerate([*bits, bits[5]])]
    batch = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], ["hash", "doc", "at", "around", "further"])
    got = [tuple(r.values()) for b in passages.linked(iter([batch])) for r in b.to_pylist()]
    assert (11, 10, 5, 10) in got


def test_edited_passages_of_phrases_that_other_documents_have(spark):
    """Every run of seven words between the edits of a passage stands also in unrelated documents before and between."""
    rng = random.Random(26)
    shared = [words_of(rng, 63) for _ in range(6)]

    def scattered():
        runs = [p[i : i + 7] for p in shared for i in range(0, 63, 8)]
        rng.shuffle(runs)
        return [sum((r + words_of(rng, 9) for r in runs[k::6]), []) for k in range(6)]

    before, between = (sum((scattered() for _ in range(6)), []) for _ in range(2))
    originals = [words_of(rng, 20) + p + words_of(rng, 20) for p in shared]
    copies = [words_of(rng, 20) + [w if i % 8 != 7 else "zz" for i, w in enumerate(p)] + words_of(rng, 20) for p in shared]
    found = found_in(spark, before + originals + between + copies)
    last = len(before) + len(originals) + len(between)
    assert {i: w for i, w in found.items() if w} == {last + i: set(range(20, 83)) for i in range(6)}


def test_shuffle_files_are_freed_at_once(spark):
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    table = storage.kept(spark.range(1000).repartition("id"), "freed")
    storage.free_shuffles(spark)
    for _ in range(50):
        if tracker.shuffleStatuses().size() <= before:
            break
        time.sleep(0.1)
    assert tracker.shuffleStatuses().size() <= before and table.count() == 1000


def test_growth_equals_brute_force():
    rng = random.Random(12)
    for _ in range(300):
        a, b = ([rng.randint(0, 2) for _ in range(rng.randint(0, 12))] for _ in range(2))
        na, nb, edits = passages.grown(a, b, 3.0)
        assert edits == passages.distance(np.array(a[:na]), np.array(b[:nb])) or (na, nb) == (0, 0)


def best_chain(x, y):
    """The highest score of a chain, by trying all predecessors."""
    k, cost = passages.SEED_WORDS, passages.GAP_COST
    score = []
    for i in range(len(x)):
        before = [score[j] - cost * (x[i] + y[i] - x[j] - y[j] - 2 * k) for j in range(i) if x[j] < x[i] and y[j] < y[i]]
        score.append(k + max([0.0, *before]))
    return score


def test_growth_between_unlike_and_equal_words_takes_no_steps():
    class Words(list):
        """Words that are compared one by one only while growth takes steps."""

        steps = 0

        def __getitem__(self, place):
            Words.steps += isinstance(place, int)
            return super().__getitem__(place)

    unlike = passages.grown(Words(range(60)), Words(range(100, 160)), passages.EDIT_COST)
    late = passages.grown(Words(range(60)), Words([*range(100, 110), *range(10, 60)]), passages.EDIT_COST)
    equal = passages.grown(Words(range(60)), Words(range(64)), passages.EDIT_COST)
    assert (unlike, late, equal, Words.steps) == ((0, 0, 0), (0, 0, 0), (60, 60, 0), 0)


def test_bits_around_seeds_are_made_once_for_each(monkeypatch):
    rng = random.Random(4)
    texts = pa.array([" ".join(rng.choices("abcdefgh", k=rng.choice([0, 3, 4, 30, 90]))) for _ in range(40)])
    words, _, _, owner = passages.word_hashes(texts)
    made, plain_bits, real = [], [], passages.around

    def plain_around(words, owner, first, width, skip):
        """Word by word."""
        out = []
        for f, w in zip(first.tolist(), width.tolist()):
            bits = 0
            for k in range(passages.AROUND):
                for place, half in ((f - 1 - k, 1), (f + w + k, 0)):
                    if 0 <= place < len(words) and owner[place] == owner[f]:
                        code = int(words[place]) << skip >> 64 - passages.AROUND_BITS & 7
                        bits |= code << passages.AROUND_BITS * (k + half * passages.AROUND)
            out.append(bits)
        return out

    def around(*args):
        made.append(len(args[2]))
        plain_bits.append((real(*args).tolist(), plain_around(*args)))
        return real(*args)

    monkeypatch.setattr(passages, "around", around)
    monkeypatch.setattr(passages.F, "arrow_udf", lambda kind: lambda find: lambda text, key: find(iter([(text, key)])))
    keys = pa.array(range(len(texts)), pa.int32())
    found = [len(c.flatten()) for turn in range(passages.SEED_ROUNDS) for c in passages.seeds_of(texts, keys, turn)]
    assert sum(made) == 2 * sum(found) and sum(found) > 100
    assert all(a == b for a, b in plain_bits)


def test_chains_hold_every_match_once_and_start_with_the_best():
    rng = random.Random(6)
    for _ in range(100):
        points = sorted({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.randint(1, 25))})
        x, y = [p[0] for p in points], [p[1] for p in points]
        found = passages.chains(x, y)
        assert sorted(i for c in found for i in c) == list(range(len(x)))
        for c in found:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))
        best = best_chain(x, y)
        end = max(range(len(x)), key=lambda i: (best[i], -i))
        first = next(c for c in found if end in c)
        assert first[-1] == end


# ---------------------------------------------------------------- toxicity


def test_toxicity(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/../sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/../sf0.1/labels.parquet")
    chain = toxicity.train(docs, labels.filter("doc_id % 5 != 0"))
    held = toxicity.toxicity(docs.join(labels.filter("doc_id % 5 = 0"), "doc_id"), chain).collect()
    hit = sum(r["is_toxic"] and r["toxic"] == 1 for r in held)
    assert hit > 0.8 * sum(r["toxic"] for r in held)
    assert sum(r["is_toxic"] and r["toxic"] == 0 for r in held) < 0.01 * len(held)
    calm = toxicity.toxicity(odd.withColumn("p_toxic", F.lit("clash")), chain)
    assert calm.count() == odd.count() and calm.filter("is_toxic").count() == 0
    assert toxicity.toxicity(none, chain).count() == 0
    unlearned = toxicity.train(docs, labels.filter("false"))
    assert toxicity.toxicity(odd, unlearned).filter("is_toxic").count() == 0


def test_chain_feeds_earlier_categories():
    texts = ["vile vile awful nasty text"] * 8 + ["awful words here"] * 8 + ["fine plain text"] * 80
    chain = toxicity.fit(texts, [True] * 16 + [False] * 80)
    assert [len(w) for w in chain.weights] == [len(chain.terms) + k + 1 for k in range(3)]
    p = chain.probabilities(chain.present(pa.array(["nasty awful vile", "fine text", None])))
    assert p[0, 2] > 0.5 > p[1, 2] and p[2, 2] < 0.5


def test_logistic_regression_equals_gradient_steps():
    rng = np.random.default_rng(3)
    x = (rng.random((60, 4)) < 0.4).astype(float)
    y = (x[:, 0] + x[:, 1] * 0.5 + rng.random(60) > 1).astype(float)
    w = np.zeros(5)
    penalty = np.append(np.full(4, toxicity.RIDGE), 1e-6)
    whole = np.hstack([x, np.ones((60, 1))])
    for _ in range(20_000):
        w -= 0.02 * (whole.T @ (1 / (1 + np.exp(-whole @ w)) - y) + penalty * w)
    assert np.abs(toxicity.logistic(x, y) - w).max() < 1e-6


def test_terms_are_chosen_without_the_held_texts():
    """A word of the toxic texts of one fold only is no term for that fold."""
    texts = [("vile thing" if i % 5 else "vile rareword") if i < 400 else "fine plain text" for i in range(4000)]
    toxic = np.array([i < 400 for i in range(4000)])
    terms, where, owner = toxicity.candidates(pa.array(texts, pa.large_string()), toxic)
    rare = set(toxicity.term_hashes(pa.array(["rareword"], pa.large_string()))[0].tolist())
    assert rare & set(terms.tolist())
    fold = np.arange(4000) % 5
    chosen = toxicity.informative(len(terms), where, owner, toxic, fold != 0)
    assert not rare & set(terms[chosen].tolist())
    whole = toxicity.informative(len(terms), where, owner, toxic, fold >= 0)
    assert rare & set(terms[whole].tolist())


# ---------------------------------------------------------------- rules


def test_rules(spark, odd, none):
    for r in rules.ledger(odd).collect():
        text = r["text"] or ""
        if len(text) > 10_000:
            continue
        own = plain.words(text)
        lines = [x for x in text.split("\n") if plain.words(x)]
        assert (r["n_words"], r["word_chars"]) == (len(own), sum(map(len, own)))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == plain.repeated_words(text)
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert bool(r["failed_bits"] & 1) == (len(own) < 50)
    assert rules.ledger(none).count() == 0


def test_ablations_count_from_bits_alone(spark, none):
    bits = spark.createDataFrame([(b,) for b in (0, 0, 1, 1, 2, 3, 1 << 4)], "failed_bits bigint")
    found = {r["rule"]: tuple(r)[2:] for r in rules.ablations(bits, rules.BASE).collect()}
    assert found == {"few_words": (3, 2, 5), "repeated_words": (2, 1, 4)}
    empty = rules.ablations(bits.filter("false"), rules.STRICT).collect()
    assert all(tuple(r)[2:] == (0, 0, 0) for r in empty) and len(empty) == len(rules.RULES)


# ---------------------------------------------------------------- simhash


def test_near_duplicates(spark, odd, none, documents):
    for frame in (odd, documents):
        found = simhash.near_duplicates(frame).collect()
        assert Counter(tuple(r[c] for c in ("doc_id", "fingerprint", "component_id")) for r in found) == Counter(
            plain.near_duplicates(rows_of(frame))
        )
    assert simhash.near_duplicates(none).count() == 0


def test_one_of_each_keeps_one_row_of_each_component(spark, odd):
    left = simhash.one_of_each(odd)
    assert left.columns == odd.columns
    groups = {c for _, _, c in plain.near_duplicates(rows_of(odd))}
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(ids) == sorted(groups)


@pytest.mark.parametrize("group", [16_384, 100])
def test_index_finds_all_links_of_tight_clusters(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(1)
    prints = set()
    for base in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(400):
            value = base
            for _ in range(rng.randrange(7)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    rows = simhash.below_patterns(spark.createDataFrame([(x,) for x in signed], "fp bigint"), 4)
    keys = ["mask", "pattern", "i", "j"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "rank")
    edges = rows.mapInArrow(lambda b: simhash._search(b, 4), "u bigint, v bigint")
    found = dict(graph.components(edges).collect())
    array, parent = np.array(signed, np.int64).view(np.uint64), list(range(len(signed)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(signed)):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= 4).tolist():
            parent[root(i)] = root(j)
    lowest = {}
    for i, x in enumerate(signed):
        lowest[root(i)] = min(lowest.get(root(i), x), x)
    for i, x in enumerate(signed):
        assert found.get(x, x) == lowest[root(i)]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 100), (8, 7)], "u bigint, v bigint")
    assert dict(graph.components(edges).collect()) == {**{i: 0 for i in range(61)}, 100: 100}
    assert graph.components(edges.filter("false")).count() == 0


def test_null_ids_of_many_texts_are_told_apart(spark):
    n = 200_000
    docs = spark.range(n).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    assert passages.keyed(docs, "text", "doc_id").select("doc", "key").distinct().count() == n


def test_two_texts_with_one_name_are_not_cut(spark, monkeypatch):
    """Names of few bits: texts of one id that share a name keep all their words."""
    monkeypatch.setattr(passages, "name_of", lambda text, id: (F.col(id), F.lit(1)))
    base = " ".join(f"w{i}" for i in range(70)) + "."
    docs = spark.createDataFrame([(1, base), (2, base + " more"), (2, "something else")], "doc_id bigint, text string")
    assert sorted(map(tuple, passages.without_passages(docs).collect())) == sorted(map(tuple, docs.collect()))


def test_columns_that_clash_with_what_operators_use_inside_stay(spark):
    names = ["of", "fp", "_id", "doc", "key", "at", "lang", "words", "bits", "n", "row", "first"]
    docs = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id bigint, text string")
    docs = docs.withColumns({n: F.lit(n) for n in names})

    def kept(frame):
        return all(tuple(r[n] for n in names) == tuple(names) for r in frame.collect()) and frame.count() == 2

    parser = language.Parser(["x"], ["abc abc"], [1.0])
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert kept(simhash.near_duplicates(docs))
    assert kept(language.identify(docs, parser))
    assert kept(tokens.count_tokens(docs, PIECES))
    assert kept(toxicity.toxicity(docs, toxicity.fit([], [])))
    assert kept(rules.ledger(docs))
    assert kept(passages.without_passages(docs))
    assert kept(decontam.contamination(docs, nothing))
    assert packing.pack(docs, BYTES, RANKS).count() == 2
    assert passages.passages(docs).count() == 0


def test_queries_have_all_operators():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14))


def test_seeds_and_links_shuffled_together_are_those_of_single_rows():
    rng = random.Random(33)
    base = [" ".join(rng.choices("abcdefghijkl", k=60)) for _ in range(6)]
    texts = pa.array([" ".join(rng.sample(base, 2)) if k % 3 else " ".join(rng.choices("mnopqrst", k=50)) for k in range(60)])
    docs, keys = pa.array([k // 2 * 7 - 40 + (1 << 40) * (k % 5 == 0) for k in range(60)], pa.int64()), pa.array(range(60), pa.int32())
    single = [
        (int(h), docs[start + k].as_py(), int(at), int(near), int(far))
        for turn in range(passages.SEED_ROUNDS)
        for start, n in ((0, 25), (25, 35))
        for _, of, *rows in passages._seed_rows(texts.slice(start, n), keys.slice(start, n), turn)
        for k, h, at, near, far in zip(of.tolist(), *rows)
    ]
    names = ["hash", "doc", "at", "around", "further"]
    rows = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*sorted(single))], names)
    wanted = sorted(tuple(r.values()) for b in passages.linked(iter([rows])) for r in b.to_pylist())
    batch = pa.record_batch([docs, keys, texts], ["doc", "key", "text"])
    got = []
    for turn in range(passages.SEED_ROUNDS):
        packed = pa.Table.from_batches(passages.packed_seeds(iter([batch.slice(0, 25), batch.slice(25)]), turn, 5))
        assert packed.num_rows <= 10  # five buckets of each batch, however many seeds
        packed = packed.sort_by("bucket").to_batches(max_chunksize=3)
        links = pa.Table.from_batches(passages.packed_links(iter(packed), 4)).sort_by("bucket").to_batches()
        for columns in passages._unpacked(iter(links), 8):
            got += zip(*(passages._whole(*columns[k : k + 2]).tolist() for k in (0, 2, 4, 6)))
    assert sorted(got) == wanted and len(wanted) > 100


def test_chains_aligned_at_once_are_as_aligned_one_by_one(monkeypatch):
    rng = random.Random(34)
    columns, wanted = [[] for _ in range(6)], []
    for k in range(400):
        a = [rng.randint(0, rng.choice([3, 40, 4000])) for _ in range(rng.randint(4, 190))]
        b = [w if rng.random() > rng.choice([0, 0, 0.1, 0.3]) else rng.randint(0, 4000) for w in a]
        b = b if k % 5 else [*b[: len(b) // 2], 7, *b[len(b) // 2 :]]
        first, last = rng.choice([0, 0, 30]), rng.choice([0, 0, 30])
        a, b = [rng.randint(0, 30) for _ in range(first)] + a, [rng.randint(0, 30) for _ in range(first)] + b + [1] * last
        xs = sorted(rng.sample(range(first, len(a) - 3), min(rng.choice([1, 1, 3, 9]), len(a) - first - 3)))
        ys = [x + (not k % 5 and x > len(a) // 2 and x + 5 <= len(b)) for x in xs]
        low, ref_low = rng.randint(0, 9), rng.randint(0, 9)
        got = passages.aligned(np.array(a), np.array(b), np.array(xs), np.array(ys), 0.8)
        wanted.append([(g[0] + low, g[1] + low, g[2] + ref_low, g[3] + ref_low, g[4]) for g in got])
        for column, value in zip(columns, (a, b, [x + low for x in xs], [y + ref_low for y in ys], low, ref_low)):
            column.append(value)
    lists = [pa.array(c, pa.list_(pa.int32())) for c in columns[:4]]
    alone, plain = [], passages.aligned
    monkeypatch.setattr(passages, "aligned", lambda *args: alone.append(1) or plain(*args))
    found, edges = passages.aligned_all(*lists, *map(np.array, columns[4:]), 0.8)
    found = [tuple(f) for f in found.tolist()]
    assert [found[i:j] for i, j in zip(edges, edges[1:])] == wanted and len(alone) < 250
    sliced, edges = passages.aligned_all(*(c.slice(100) for c in lists), *(np.array(c[100:]) for c in columns[4:]), 0.8)
    assert [tuple(f) for f in sliced.tolist()] == [f for w in wanted[100:] for f in w]
