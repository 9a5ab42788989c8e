"""Operators for training data against brute force, on small tables with every awkward row."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("terrace.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")

from terrace.llm import boosted_trees, class_lm, inner_product, line_rules, mixing, near_duplicates, personal, superminhash, token_rows, toxicity, vector_packing  # noqa: E402
from terrace.llm.components import components  # noqa: E402
from terrace.llm.queries import TOKENIZER  # noqa: E402
from terrace.llm.tables import remainder, ship_package  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, value double, span int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(5)
    vocabulary = [f"w{i}x" for i in range(300)]
    base = [" ".join(chance.choices(vocabulary, k=n)) for n in (120, 200, 60, 400)]
    texts = [None, "", "  \n\t ", "one", "Two words", *base, *base[:2]]
    for text in base:  # near copies: some words changed
        for changed in (1, 2, 5, 30):
            parts = text.split(" ")
            for at in chance.sample(range(len(parts)), changed):
                parts[at] = chance.choice(vocabulary)
            texts.append(" ".join(parts))
    texts += [
        "mail a.b@c.org, Mail x@y@z.example.com or 1.2.3.4 and 1.2.3.400 call +1 (599) 555-3756 now",
        "card 4111 1111 1111 1111 not 4111 1111 1111 1112; v1.2.3.4.5.6.7.8 é 😀 +49 30 12345678 q@w",
        "long " * 30_000 + "end@long.example.org",
        "same line of words here\n" * 12 + "### $$$ |\nother",
    ]
    out = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), "x", 1.0, 2) for i, t in enumerate(texts)]
    return out + [out[6], out[1], (None, "no id but words 10.0.0.1", "en", "s1", 5, "x", 1.0, 2)]


@pytest.fixture(scope="module")
def documents(spark, rows):
    ship_package(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found_by_rule(text):
    forms = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for rank, (kind, form) in enumerate(forms.items()):
        for m in re.finditer(form, text or ""):
            digits = [int(c) for c in m[0] if c.isdigit() and c.isascii()]
            doubled = [(d * 2 - 9 if d > 4 else d * 2) if i % 2 else d for i, d in enumerate(reversed(digits))]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_equal_the_rules(documents, empty):
    got = personal.find_personal_data(documents)
    seen = got.select("text", personal.shown(F.col("base_spans")).alias("s"), F.sha2(personal.shown(F.col("base_spans")), 256).alias("h"), "value").collect()
    assert len(seen) == documents.count()
    for row in seen:
        assert row.s == found_by_rule(row.text) and row.h == hashlib.sha256(row.s.encode()).hexdigest() and row.value == 1.0
    assert personal.find_personal_data(empty).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    texts = [f"please write to {n}@mail.example.com today" for n in ("ann", "bob", "cy", "dan", "eve")] + ["please write to zoe@intranet today", "room 12 is free"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in personal.find_personal_data(docs).select("doc_id", personal.shown(F.col("all_spans")).alias("s")).collect()}
    assert got[5] == "context_email:16:28" and got[6] == "" and got[0].startswith("email:")


def test_masking_replaces_spans(documents):
    one = personal.find_personal_data(documents.where("text like 'mail %'")).select(personal.masked(F.col("text"), F.col("all_spans")).alias("t")).first().t
    assert "x@[EMAIL]" in one and "mail [EMAIL]," in one and "[IP]" in one and "1.2.3.400" in one and "[PHONE] now" in one


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_cover_every_id_once(documents, rows, empty, capacity):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(TOKENIZER)
    got = vector_packing.pack_documents(documents, TOKENIZER, capacity=capacity).toPandas()
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for start in range(0, len(ids), capacity):
            piece = ids[start : start + capacity]
            want[(-1 if doc_id is None else doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(tuple(int(x) for x in r) for r in got[names].fillna(-1).to_numpy()) == want
    ordered = got.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id")["length"].cumsum()
    assert ((ends - ordered["length"]) == ordered["offset"]).all() and ends.max() <= capacity
    assert vector_packing.pack_documents(empty, TOKENIZER).count() == 0


def test_packing_keeps_every_limit():
    chance = np.random.default_rng(1)
    demand = np.stack([chance.integers(1, 100, 500), np.ones(500, dtype=int), chance.integers(0, 50, 500)], axis=1)
    limits = np.array([100, 4, 60])
    bins = vector_packing.pack_vectors(demand, limits)
    totals = np.stack([np.bincount(bins, demand[:, i]) for i in range(3)], axis=1)
    assert (totals <= limits).all() and len(totals) <= 1.35 * max(demand.sum(axis=0) / limits)


def test_conversations_pack_under_loss_limits(spark):
    turns = spark.createDataFrame([(i, 10 + i % 7, 3 + i % 5, "t") for i in range(200)], "conv long, tokens long, loss_tokens long, text string")
    got = vector_packing.pack_examples(turns, capacity=50, most_segments=4, most_loss=14).toPandas()
    sums = got.groupby("sequence_id").agg(t=("tokens", "sum"), n=("conv", "size"), l=("loss_tokens", "sum"))
    assert len(got) == 200 and sums.t.max() <= 50 and sums.n.max() <= 4 and sums.l.max() <= 14


def test_token_rows_round_trip(documents, rows, empty):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(TOKENIZER)
    got = token_rows.token_rows(documents, TOKENIZER, width=64).toPandas()
    back = Counter()
    for row in got.itertuples():
        ids = np.frombuffer(row.ids, dtype="<u2")
        assert len(ids) == 64 and row.cu_seqlens[-1] == row.n_tokens
        for d, s, a, b in zip(row.doc_ids, row.starts, row.cu_seqlens[:-1], row.cu_seqlens[1:]):
            back[(-1 if d is None or d != d else int(d), int(s), tuple(ids[a:b].tolist()))] += 1
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 64):
            want[(-1 if doc_id is None else doc_id, s, tuple(ids[s : s + 64]))] += 1
    assert back == want and token_rows.token_rows(empty, TOKENIZER).count() == 0
    assert token_rows.position_resets([0, 3, 5], 8).tolist() == [0, 1, 2, 0, 1, 0, 1, 2]


def test_mix_meets_targets(documents, rows, empty):
    got = mixing.mix(documents).collect()
    size = Counter()
    for _, text, _, source, *_ in rows:
        size[source] += len(words(text))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip((size[n] for n in names), mixing.targets([size[n] for n in names], [1, 2, 3, 1][: len(names)])))
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(d.words for d in r.draws)
        taken[r.source_size] += r.taken
    assert len(got) == len(rows) and all(taken[s] == round(t) for s, t in want.items())
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(documents.repartition(5)).collect()))
    assert mixing.mix(empty).count() == 0
    texts = mixing.mixed_documents(documents)
    assert texts.columns == documents.columns
    assert sum(len(words(r.text)) for r in texts.select("text").collect()) == sum(taken.values())


def test_splitting_tree_deals_everything_evenly():
    counts = mixing.splitting_tree(np.array([100, 7, 0, 33]), 8, 3)
    assert counts.sum(axis=1).tolist() == [100, 7, 0, 33] and np.ptp(counts.sum(axis=0)) <= 1 and (counts >= 0).all()
    assert mixing.targets([10, 1000, 10], [3, 1, 3]) == pytest.approx([30, 960, 30])


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(documents, rows, empty, size, percent):
    sets = {}
    for doc_id, text, *_ in rows:
        w = [x.lower() for x in words(text)]
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    group = {i: i for i in sets if i is not None}
    for _ in group:
        for a in group:
            for b in group:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    group[a] = group[b] = min(group[a], group[b])
    got = near_duplicates.near_duplicates(documents, size, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id]) and r.component_id == group.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    kept = near_duplicates.without_near_duplicates(documents, shingle_words=size, percent=percent)
    assert kept.columns == documents.columns and kept.count() == len(set(group.values())) + 1
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_signatures_estimate_similarity():
    chance = np.random.default_rng(2)
    elements = chance.integers(0, 2**63, 1500).astype(np.uint64)
    a, b = np.sort(elements[:1000]), np.sort(elements[500:])
    s = superminhash.signatures(np.r_[a, b, a[:3]], np.array([1000, 1000, 3]), 1024)
    assert np.isfinite(s).all() and (s[0] == s[1]).mean() == pytest.approx(1 / 3, abs=0.05)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50, 60), (60, 55), (70, 70)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 50: 50, 55: 50, 60: 50}


def test_trees_separate_classes():
    chance = np.random.default_rng(3)
    x = chance.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    model = boosted_trees.train(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95
    assert (boosted_trees.train(x[:0], y[:0]).score(x[:3]) == 0.5).all()


def test_toxicity_separates_and_survives_no_labels(spark):
    chance = random.Random(4)
    plain = [a + b + "en" for a in "bcdfghklmnprst" for b in ("a", "e", "i", "o", "u", "ar", "or", "im")]
    marked = ["zqual" + e for e in "abcdefgh"] + ["idiot", "moron"]
    texts = [" ".join(chance.choices(plain, k=60) + (chance.choices(marked, k=4) if i % 4 == 0 else [])) for i in range(400)] + [None, ""]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    learn = lambda c: F.crc32(c.cast("string").cast("binary")) % 5 != 0
    model = toxicity.train_toxicity(docs, labels, "toxic", learn)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in held) >= 0.95 * len(held) and got[400] == got[401] < 0.5
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    nothing = toxicity.train_toxicity(docs, labels.where("false"), "toxic", learn)
    assert {r.score for r in toxicity.toxicity_scores(docs, nothing).collect()} == {0.5}


def test_rules_equal_brute_force(documents, rows, empty):
    got = {}
    for r in line_rules.quality_rules(documents).collect():
        got.setdefault(r.doc_id, r)
    for doc_id, text, *_ in rows:
        w, r = words(text), got[doc_id]
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r.kept and r.base_failed)
    assert line_rules.quality_rules(documents).count() == len(rows) and line_rules.quality_rules(empty).count() == 0


def test_common_lines_deplete_documents(spark):
    shared = "this passage stands in very many documents of one host and says nothing of its own at all"
    texts = [f"{shared}\nown words number {'abcdefghij'[i % 10] * (i + 1)}" for i in range(30)] + ["a text of its own with more than ten words in it that nobody shares"] * 20
    docs = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in line_rules.quality_rules(docs).collect()}
    assert not got[0] and all(got[i] for i in range(30, 50))


def test_products_equal_brute_force(spark):
    chance = np.random.default_rng(6)
    data = [(int(i), [float(x) for x in chance.normal(size=6)], 0) for i in range(700)]
    data += [data[100], data[5], (701, None, 0), (800, [float("nan")] * 6, 0), (900, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (None, [1.0] * 6, 0)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int")
    whole = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v, _ in data[:702]]
    got = {}
    for r in inner_product.top_products(frame, F.col("vec_id") % 100 == 0, shard_rows=100, query_block=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for i, v in whole[:700:100]:
        best = sorted((-int(v @ u), j) for j, u in whole if j != i)[:10]
        assert sorted(got.pop(i)) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert not got


def test_base_scores_equal_counts(documents, rows, empty):
    learn = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1
    tokens = lambda t: [*(w.translate({c: c + 32 for c in range(65, 91)}) for w in words(t)), None]
    seen = Counter(w for i, t, *_ in rows if learn(i) for w in tokens(t))
    total, kinds = sum(seen.values()), len(seen)
    got = {}
    for r in class_lm.class_scores(documents, remainder("doc_id", 5) != 1, head_words=50, unit_words=20, classes=8).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in rows:
        r, w = got[i][0], tokens(t)
        base = sum(np.log10((seen[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(seen[x] > 0 for x in w), total) and r.base_score == pytest.approx(base) and r.score < 0
    assert sum(map(len, got.values())) == len(rows)
    assert class_lm.class_scores(empty, remainder("doc_id", 5) != 1).count() == 0


def test_exchange_raises_the_likelihood():
    chance = np.random.default_rng(7)
    counts = chance.integers(0, 3, (40, 40)) + 30 * (chance.integers(0, 3, 40)[:, None] == chance.integers(0, 3, 40))

    def information(of):
        member = np.eye(4)[of]
        between = member.T @ counts @ member
        entropy = lambda x: float((x * np.log(np.maximum(x, 1e-300))).sum())
        return entropy(between) - entropy(between.sum(axis=0)) - entropy(between.sum(axis=1))

    often = np.argsort(-counts.sum(axis=0), kind="stable")
    start = np.empty(40, dtype=int)
    start[often] = np.arange(40) % 4
    runs = [information(start)] + [information(class_lm.exchange(counts, classes=4, sweeps=n)) for n in (1, 2, 8)]
    assert runs == sorted(runs) and runs[-1] > runs[0]
