"""Corpus operators on documents: edge cases and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caredeck.llm import best_fit, hyperminhash, pii_bootstrap, seed_extend, source_mix, toxicity_chain
from caredeck.llm.best_fit import BestFit, Tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_shingles string, size string, taken string, kept string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BASE = " ".join(f"w{i * 7919 % 1000}" for i in range(400))


def words(start, n):
    return " ".join(f"v{start}x{i}" for i in range(n))


NEAR = BASE.replace("w7 ", "changed ", 1)
TEXTS = {
    1: BASE, 2: BASE, 3: NEAR, 4: "Solo words here", 5: "solo WORDS  here", 6: None, 7: "", 8: " \n\t", 9: words(1, 30) + " " + BASE,
    10: words(2, 60) + " " + words(3, 60), 11: words(3, 60) + "\n" + words(4, 30), 12: "a b c d",
    13: "mail a.b+c@x-y.example.org, call +1 (212) 555-0188 or 4111 1111 1111 1111 at 10.0.0.255 not 10.0.0.256",
    14: "x" * 300_000 + " tail", 15: "@" * 50 + " 1" * 400,
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 0, "clash", "clash", "clash", "clash") for i, t in TEXTS.items()]
    rows += [rows[3], (None, "lost", None, None, None, None, None, None, None), (None,) * 9]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    links = [
        (a, b) for a, b in combinations(texts, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    for _ in texts:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return sets, root


def test_near_duplicates(docs):
    got = hyperminhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    sets, root = brute_components(TEXTS)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)


def test_near_duplicate_buckets_of_many_components(spark):
    """Documents that share a passage, few of which are linked: the comparison across components finds them."""
    common = words(90, 200)
    texts = {i: f"{common} {words(100 + i, 60 + i % 7 * 20)}" for i in range(80)}
    texts |= {200 + i: texts[i].replace("x3 ", "y3 ") for i in range(0, 80, 9)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    _, root = brute_components(texts)
    assert {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(frame).collect()} == root


def test_one_of_each_stays(docs):
    kept = hyperminhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    _, root = brute_components(TEXTS)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(root.values()))


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    """Half of the rows are of id 0: one near-duplicate of a smaller id, copies, two near copies, the rest unlike anything."""
    rows = [(-5, BASE), (0, NEAR), (3, words(7, 40)), (0, words(8, 40)), (9, words(8, 40)), (0, words(8, 40)), (0, words(8, 40).upper())]
    rows += [(0, words(300 + i, 40)) for i in range(10)] + [(0, words(400, 200)), (0, words(400, 200).replace("v400x3 ", "y "))]
    rows += [(0, ""), (0, None), (None, BASE), (None, BASE)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    judged = hyperminhash.near_duplicates(frame).collect()
    assert len(judged) == len(rows)
    assert sorted((r.component_id, r.kept) for r in judged if r.doc_id in (-5, 3, 9)) == [(-5, True), (0, False), (3, True)]
    assert sorted((r.component_id, r.kept) for r in judged if r.doc_id == 0) == [(-5, False)] + [(0, False)] + [(0, True)] * 16
    got = [(r.doc_id, (r.text or "").lower()) for r in hyperminhash.keep_one_of_each(frame).collect()]
    near = [t for i, t in got if t.endswith("v400x199")]
    assert len(near) == 1
    want = [(-5, BASE.lower()), (3, words(7, 40)), (0, words(8, 40)), (0, near[0]), (0, ""), (None, BASE.lower()), (None, BASE.lower())]
    want += [(0, words(300 + i, 40)) for i in range(10)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_registers_estimate_similarity():
    cache, rolling = hyperminhash.WordHashes(), hyperminhash.RollingHash()
    a, b = (hyperminhash.shingle_hashes(t.encode().split(), cache, rolling) for t in (BASE, NEAR))
    import numpy as np

    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    ra, rb = hyperminhash.registers(a), hyperminhash.registers(b)
    assert abs(hyperminhash.estimate(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[0] - exact) < 0.15
    assert not hyperminhash.registers(a[:0]).any()


def brute_repeats(texts):
    first, out = {}, {}
    lists = {i: (t or "").encode().split() for i, t in texts.items()}
    for i in sorted(lists):
        for k in range(len(lists[i]) - 49):
            first.setdefault(tuple(lists[i][k : k + 50]), i)
    for i, w in lists.items():
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup(docs):
    rows = seed_extend.without_repeats(docs).collect()
    assert len(rows) == docs.count()
    expected = brute_repeats(TEXTS)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) == expected[r.doc_id]
        else:
            assert r.n_removed == 0


def test_mixing(docs):
    rows = source_mix.mix(docs).collect()
    assert len(rows) == docs.count() and sorted(map(tuple, rows), key=str) == sorted(map(tuple, source_mix.mix(docs).collect()), key=str)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", TEXTS.get(r.doc_id) or "")) or r.doc_id is None
        assert 0 <= r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
    by_target = {}
    for r in rows:
        by_target.setdefault((r.target, r.source_size), []).append(r)
    for (target, _), members in by_target.items():
        assert abs(sum(r.taken for r in members) - target) <= max(r.size for r in members) / 2 + 1
    assert source_mix.mixed_documents(docs).columns == docs.columns


def test_mixing_of_many_sources(spark):
    """More sources than any driver table holds: every one gets its share, as the same sum on the driver says."""
    n = 210_000
    frame = spark.range(n).selectExpr("id as doc_id", "concat('d', id, '.org') as source", "if(id % 2 = 0, 'a b c', 'a') as text")
    got = source_mix.mix(frame)
    assert got.count() == n
    sizes = {f"d{i}.org": 3 if i % 2 == 0 else 1 for i in range(n)}
    weight = {s: source_mix.WEIGHTS[k % 3] for k, s in enumerate(sorted(sizes))}
    quota = source_mix.targets(sizes, weight)
    want = {s: int(2 * round(quota[s]) >= z) + int(2 * round(quota[s]) >= 3 * z) for s, z in sizes.items()}
    for r in got.collect():
        s = f"d{r.doc_id}.org"
        assert abs(r.target - quota[s]) < 1e-6 and r.source_size == r.size == sizes[s]
        assert r.taken == r.size * want[s]


def test_mixing_of_overlapping_sources(spark):
    """Two groups of connected sources and a lone one, against the flow over all of them at once."""
    kinds = [["a"], ["b", "a"], ["b"], ["x", "y"], [None, "y"], ["y"], ["q"], ["z", "x"]]
    rows = [(i, "w " * (1 + i % 3), kinds[i % 8]) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, listed array<string>")
    got = {r.doc_id: r for r in source_mix.mix(frame, members="listed").collect()}
    patterns, sizes, taken = {}, {}, {}
    for i, text, listed in rows:
        p = tuple(sorted(listed, key=lambda s: (s is None, s or "")))
        patterns[p] = patterns.get(p, 0) + got[i].size
        taken[p] = taken.get(p, 0) + got[i].taken
        for s in p:
            sizes[s] = sizes.get(s, 0) + got[i].size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    quota = source_mix.targets(sizes, {s: source_mix.WEIGHTS[k % 3] for k, s in enumerate(order)}, source_mix.SHARE * sum(patterns.values()) / sum(sizes.values()))
    flow = source_mix.route(patterns, quota)
    assert len(got) == 400 and abs(sum(taken.values()) - sum(flow.values())) <= 2 * len(patterns)
    assert all(abs(got[i].target - quota[min(k, key=lambda s: (s is None, s or ""))]) < 1e-9 for i, _, k in rows)


def test_targets_and_flow():
    assert source_mix.targets({"a": 100, "b": 100}, {"a": 3, "b": 1}) == {"a": 200.0, "b": 100.0}
    assert source_mix.targets({}, {}) == {}
    taken = source_mix.route({("a",): 10, ("a", "b"): 10, ("b",): 5}, {"a": 15, "b": 12})
    assert sum(taken.values()) == 27 and max(taken[p] / s for p, s in {("a",): 10, ("a", "b"): 10, ("b",): 5}.items()) <= 2
    assert taken[("a", "b")] >= 10


def test_packing(docs):
    import numpy as np
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = best_fit.pack(docs, RANKS).collect()
    assert sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 4 for r in rows) == 2  # rows of their own
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    for i, text in TEXTS.items():
        if i == 4:
            continue  # occurs twice
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert sum(p.length for p in pieces) == len(ids) and all(p.length == 1024 for p in pieces[1:])
        for p in pieces:
            assert zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
    for members in by_bin.values():
        at = 0
        for p in sorted(members, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024


def test_tokens_against_the_plain_tokenizer():
    from tokenizers import Tokenizer

    model, tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Tokens(RANKS)
    odd = ("a  b", " a b ", "a\n b", "a \nb", "it's <|endoftext|> ok", "x  y", "end.\nNew line", "a", "x<|endoftext|>", "<|endoftext|><|endoftext|> y", " <|endoftext|")
    for text in odd:
        ids = model.encode(text, add_special_tokens=False).ids
        assert tokens.of(text) == b"".join(i.to_bytes(4, "little") for i in ids), text


def test_few_sequences_for_any_partitioning(spark):
    """A second round joins what tasks leave open: the number of sequences hardly depends on the number of tasks."""
    draw = random.Random(3)
    made = [(i, " ".join(f"w{draw.randrange(900)}" for _ in range(int(draw.lognormvariate(4.5, 1))))) for i in range(2500)]
    docs = spark.createDataFrame(made + made[:40], "doc_id long, text string")
    for tasks in (1, 8, 32):
        rows = best_fit.pack(docs.repartition(tasks), RANKS).collect()
        by_bin = {}
        for r in rows:
            by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for members in by_bin.values():
            ends = [0, *[at + n for at, n in sorted(members)]]
            assert [at for at, _ in sorted(members)] == ends[:-1] and ends[-1] <= 1024
        assert len(by_bin) <= 1.02 * sum(r.length for r in rows) / 1024 + 1
        assert len({(r.doc_id, r.piece) for r in rows}) == len({i for i, _ in made}) + sum(r.piece > 0 for r in rows) - sum(
            r.piece > 0 and r.doc_id < 40 for r in rows) // 2


def test_best_fit_prefers_the_fullest_bin_and_closes_it_beyond_the_bound():
    packer = BestFit(10, 2, 0)
    assert [packer.place(n) for n in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]
    assert packer.place(4) == (0, 6)
    assert [packer.place(n)[0] for n in (9, 8, 7)] == [2, 3, 4] and packer.place(1) == (3, 8)


def test_personal_data(docs):
    rows = {r.doc_id: r for r in pii_bootstrap.report(docs).collect()}
    text = TEXTS[13]
    wanted = [("email", "a.b+c@x-y.example.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (212) 555-0188")]
    spans = ",".join(f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in wanted)
    r = rows[13]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest() and r.spans.startswith(spans)
    assert rows[6].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[6].spans == ""
    clean = pii_bootstrap.masked(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert clean.filter("doc_id = 13").first().text == "mail [EMAIL], call [PHONE] or [CARD] at [IP] not 10.0.0.256"
    assert clean.filter("doc_id = 3").first().text == NEAR


def test_contexts_single_out_unseen_identifiers(spark):
    rows = [(i, f"lorem ipsum member card: 411111111111111{1}  and more") for i in range(6)]
    rows = [(i, f"reach us mailto: user{i}@example.org today") for i in range(12)]
    rows += [(50, "reach us mailto: K9X7720Q-1188 today"), (51, "the year 2024-05-06a7 was long")]
    found = {r.doc_id: r.spans for r in pii_bootstrap.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[50] == "id:17:30" and found[51] == ""


def test_contexts_gain_trust_in_as_many_rounds_as_it_takes(spark):
    """Each context's identifiers make the next context trusted; the last one is reached in the fourth round."""
    steps, counts = ["alpha", "beta", "gamma", "delta", "omega"], [2160, 360, 60, 10, 1]
    texts = [f"say alpha user{i}@example.org now" for i in range(counts[0])]
    for k in range(1, 5):
        for i in range(counts[k]):
            texts += [f"say {steps[k - 1]} K{k}X77{i:05d} now", f"say {steps[k]} K{k}X77{i:05d} now"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii_bootstrap.report(frame).collect()}
    assert [i for i in range(counts[0], len(texts)) if not found[i].startswith("id:")] == []


def test_base_patterns_against_plain_regexes(spark):
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    texts = ["a@b.c%d@e.f @x a@b@c.d é😀q@w.e", "1.2.3.4.5.6.7.8 1.2.3 0001.2.3.4 12345678901234567890", "12 -34 4-1-1-1 1111111111111111-",
             "5500 0000 0000 0004 55000000000000041", "+1 22 333 4444- +12(3)4.5-678 99 ++1 234567890", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for kind, pattern in plain.items():
        got = {r.doc_id: r.m for r in frame.select("doc_id", F.transform(pii_bootstrap._matches(F.col("text"), pii_bootstrap.KINDS[kind]), lambda x: F.struct(x.m, x.b, x.e)).alias("m")).collect()}
        for i, t in enumerate(texts):
            want = [(m[0], m.start(), m.end()) for m in re.finditer(pattern, t)]
            if kind == "card":
                want = [w for w in want if len(re.sub("[^0-9]", "", w[0])) >= 13]
            assert [tuple(x) for x in got[i]] == want, (kind, t)


def test_toxicity(spark, docs, empty):
    labels = "doc_id long, quality int, toxic int"
    nothing = toxicity_chain.score(docs, spark.createDataFrame([], labels)).collect()
    assert len(nothing) == docs.count() and not any(r.toxic for r in nothing)
    rows = [(i, f"{words(i, 20)} {'vile grubber' if i % 4 == 0 else 'kind word'}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame([(i, i % 2, int(i % 4 == 0)) for i in range(300)] + [(None, 1, 1), (1, None, None)], labels)
    held_out = {r.doc_id: r.toxic for r in toxicity_chain.score(frame, truth).collect() if r.doc_id >= 300}
    assert held_out == {i: i % 4 == 0 for i in range(300, 400)}
    assert toxicity_chain.score(empty, truth).count() == 0
    assert toxicity_chain.without_toxic(docs, truth).columns == docs.columns


def test_empty_tables(empty):
    assert hyperminhash.near_duplicates(empty).count() == 0
    assert hyperminhash.keep_one_of_each(empty).count() == 0
    assert seed_extend.without_repeats(empty).count() == 0
    assert source_mix.mix(empty).count() == 0
    assert best_fit.pack(empty, RANKS).count() == 0
    assert pii_bootstrap.report(empty).count() == 0


def test_features_are_counted_in_parts(monkeypatch):
    """A task hands its counts on when it holds many features; together the parts are the whole."""
    texts = [" ".join(chr(97 + (i + 1) * j % 26) * (j % 7 + 1) for j in range(20)) for i in range(60)] + [None, ""]
    truth = [float(i % 2) for i in range(len(texts))]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "toxic": truth})]

    def counted(bound):
        monkeypatch.setattr(toxicity_chain, "MOST_COUNTED", bound)
        parts = list(toxicity_chain._count_batches(iter(batches), ["toxic"]))
        sums = Counter()
        for part in parts:
            for row in part.to_pylist():
                sums[row["word"], "n"] += row["n"]
                sums[row["word"], "toxic"] += row["toxic"]
        return parts, sums

    (whole, want), (parts, got) = counted(10**9), counted(30)
    assert len(whole) == 1 and len(parts) > 2
    assert got == want and max(p.num_rows for p in parts) < whole[0].num_rows


def test_tasks_remember_few_words():
    """A text of new words only: what a task remembers stays far below a text's words."""
    features = toxicity_chain.Features()
    features.of(" ".join(map(str, range(250_000))))
    assert len(features) <= 100_000


def test_texts_go_to_python_in_small_batches(spark, docs):
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(option)
    for operator in (lambda: best_fit.pack(docs, RANKS), lambda: hyperminhash.near_duplicates(docs)):
        operator()
        assert spark.conf.get(option) == "1000"
        spark.conf.unset(option)
    spark.conf.set(option, "77")
    best_fit.pack(docs, RANKS)
    assert spark.conf.get(option) == "77"
    spark.conf.unset(option)
