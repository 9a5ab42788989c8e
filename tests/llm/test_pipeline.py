"""The five stages one after the other on planted cases, each held against what it was given."""

import random
from collections import Counter, defaultdict

import pytest

pytest.importorskip("terrace.llm")
pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from terrace.llm.queries import TOKENIZER  # noqa: E402
from terrace.llm.tables import stored, table  # noqa: E402

PLAIN = [a + b + "en" for a in "bcdfghklmnprst" for b in ("a", "e", "i", "o", "u", "ar", "or", "im")]
MARKED = ["zqual" + e for e in "abcdefgh"] + ["idiot", "moron"]


def shingles(text, size=5):
    words = [w.lower() for w in (text or "").split()]
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return bool(a) and 100 * len(a & b) >= 80 * len(a | b)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    chance = random.Random(11)
    path = str(tmp_path_factory.mktemp("corpus"))
    texts = [" ".join(chance.choices(PLAIN, k=70) + (chance.choices(MARKED, k=6) if i % 4 == 0 else [])) for i in range(240)]
    texts[1] += " write to jane.doe@mail.example.org or +1 (599) 555-3756 soon"
    texts += [None, "", " \n", texts[2], texts[2] + " bagen", texts[3].replace(" ", "  "), "long " * 20_000 + "end@long.example.org"]
    rows = [(i, t, "en", None if i % 9 == 5 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[6], (9, "another text with an id that is given twice, and nothing of the first one in it", "en", "s0", 75)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 == 0), 1) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def made(spark, folder):
    docs, out = table(spark, folder, "documents"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, folder), f"test-{name}")
    return {name: (frame.columns, frame.collect()) for name, frame in out.items()}


def held(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_stages_return_documents(made):
    columns = made["documents"][0]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    assert all(made[n][0] == columns for n in ("toxicity", "near_duplicates", "personal_data", "mixing"))


def test_toxic_documents_go_and_clean_ones_stay(made):
    given, kept = held(made["documents"][1]), held(made["toxicity"][1])
    assert not kept - given
    gone = {i for i, _ in (given - kept)}
    assert gone <= set(range(0, 240, 4)) and len(gone) >= 0.95 * 60


def test_one_document_of_each_group_stays(made):
    given, kept = made["toxicity"][1], made["near_duplicates"][1]
    assert not held(kept) - held(given)
    texts = [(r.doc_id, r.text) for r in kept]
    assert not any(alike(a[1], b[1]) for n, a in enumerate(texts) for b in texts[:n] if a[0] != b[0])
    for doc_id, text in held(given) - held(kept):
        assert any((a == doc_id and t == text) or (a < doc_id and alike(t, text)) for a, t in texts)
    assert {t for i, t in texts if i == 9} == {r.text for r in given if r.doc_id == 9}


def test_personal_data_is_masked_and_nothing_else_changes(made):
    given, masked = {(r.doc_id, len(r.text or "")): r for r in made["near_duplicates"][1]}, made["personal_data"][1]
    assert len(masked) == len(made["near_duplicates"][1])
    text = {r.doc_id: r.text for r in masked}
    assert text[1].endswith("write to [EMAIL] or [PHONE] soon") and text[246].endswith("long [EMAIL]")
    assert all(r.n_chars == len(r.text) for r in masked if "[" in (r.text or ""))
    untouched = Counter(tuple(r) for r in masked if "[" not in (r.text or ""))
    assert untouched == Counter(tuple(r) for r in given.values() if r.doc_id not in (1, 246))


def test_mix_takes_whole_documents_near_the_targets(made):
    given, taken = made["personal_data"][1], held(made["mixing"][1])
    known = held(given)
    assert set(taken) <= set(known) and all(n <= 3 * known[x] for x, n in taken.items())
    size, got, longest = Counter(), Counter(), defaultdict(int)
    for r in given:
        n = len((r.text or "").split())
        size[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in made["mixing"][1]:
        got[r.source] += len((r.text or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, sum(size.values()), set(order)
    while rest:
        share = {s: free * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = {s for s in rest if share[s] > 3 * size[s]}
        for s in above or rest:
            target[s] = 3 * size[s] if above else share[s]
        free -= sum(target[s] for s in above)
        rest -= above or rest
    assert all(abs(got[s] - target[s]) <= longest[s] / 2 + 1 for s in order)


def test_every_token_id_is_packed_once(made):
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(str(TOKENIZER))
    want = Counter()
    for r in made["mixing"][1]:
        want[r.doc_id] += len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    got, filled = Counter(), defaultdict(list)
    for r in made["packing"][1]:
        got[r.doc_id] += r.length
        filled[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for places in filled.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(n for _, n in places) <= 2048
