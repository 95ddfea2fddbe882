"""Every operator against a plain version, over awkward texts: nulls, empty, very long, repeated rows, clashing names."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import lines, minmax, packing, quality, recompression, suffix_array, token_file, toxicity, urls, winnow
from tidegauge.llm.components import components
from tidegauge.llm.native import possibly_among
from tidegauge.llm.scratch import stored


def near_texts(vocabulary, count, longest, seed):
    """Random texts that quote, copy and change one another."""
    r = random.Random(seed)
    docs = []
    for i in range(count):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, longest))]
        kind = r.random()
        if docs and kind < 0.5:
            other = r.choice(docs)[1].split(" ")
            a = r.randint(0, len(other))
            at = r.randint(0, len(words))
            words[at:at] = other[a : a + r.randint(20, 120)]
        elif docs and kind < 0.65:
            words = r.choice(docs)[1].split(" ")
        elif docs and kind < 0.8:
            words = r.choice(docs)[1].split(" ")
            for _ in range(r.randint(1, 3)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
        docs.append((3 * i + 1, " ".join(words)))
    r.shuffle(docs)
    return docs


def vocabulary(seed=1, count=2000):
    r = random.Random(seed)
    return ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(count)]


AWKWARD = [
    (1, "ab " * 300), (2, "ab " * 200 + "x " + "ab " * 100), (3, "x" * 1000), (4, None), (5, ""), (6, "x" * 999 + "y"),
    (7, "x" * 400), (7, "x" * 400), (None, "ab " * 300), (8, "a b c"), (9, "A b  c\n"), (10, "a"), (11, "a b"),
    (12, "q w e " * 60), (13, "q w e " * 80), (14, " \n\t "), (15, "é" * 500), (16, "word " * 30_000),
]
SETS = {"quotes": near_texts(vocabulary(), 120, 200, 5), "two_words": near_texts(["a", "b"], 60, 150, 6), "awkward": AWKWARD, "none": []}


def table(spark, rows):
    """Documents with columns whose names an operator might use itself."""
    extra = {c: F.lit(1) for c in ("key", "region", "hits", "tokens", "line", "words", "n_words", "head", "member", "q__x")}
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(extra).repartition(3)


def same(found, wanted):
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))


@pytest.mark.parametrize("name", SETS)
@pytest.mark.parametrize("bucket", [400, 0])
def test_suffix_array(spark, name, bucket):
    found = suffix_array.remove_repeats(table(spark, SETS[name]), bucket)
    same(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.substring_bytes(SETS[name]))
    texts = found.filter("n_removed = 0").select("doc_id", F.col("text").cast("string")).collect()
    originals = defaultdict(set)
    for doc, text in SETS[name]:
        originals[doc].add(text or "")
    assert all(text in originals[doc] for doc, text in texts)


def test_intervals_take_the_widest_left():
    suffixes = sorted([(b"zyx", b"aaab"), (b"zyw", b"aaab"), (b"q", b"aaac")], key=lambda m: m[1])
    old, suffix_array.WINDOW = suffix_array.WINDOW, 3
    try:
        found = set(suffix_array.repeat_intervals(suffixes))
    finally:
        suffix_array.WINDOW = old
    assert {(0, 2, 4), (1, 2, 4), (2, 0, 3)} <= found


@pytest.mark.parametrize("name", SETS)
def test_recompression(spark, name):
    found = recompression.remove_repeats(table(spark, SETS[name]))
    same(found.select("doc_id", "n_words", "n_removed", "kept_sha256"), brute.substring_words(SETS[name]))


def test_equal_windows_share_a_name():
    r = np.random.default_rng(0)
    for letters in (2, 3, 50):
        window = r.integers(1, letters + 1, recompression.WINDOW).astype(np.uint64)
        seen = set()
        for _ in range(40):
            before, after = (r.integers(1, letters + 1, r.integers(0, 60)).astype(np.uint64) for _ in range(2))
            names = recompression.compress(np.concatenate([before, window, after]), np.zeros(len(before) + 50 + len(after), int))
            lo, hi = len(before) + recompression.MARGIN, len(before) + recompression.WINDOW - recompression.MARGIN
            inside = (names.start >= lo) & (names.stop <= hi)
            assert inside.any()
            seen.add(tuple(zip(names.name[inside].tolist(), (names.start[inside] - lo).tolist(), strict=True)))
        assert len(seen) == 1


@pytest.mark.parametrize("name", SETS)
def test_near_duplicates(spark, name):
    same(minmax.near_duplicates(table(spark, SETS[name]), words=3, percent=85, rows=4), brute.near(SETS[name]))


def test_near_duplicates_off_the_hub(spark):
    """The earliest member is similar to the middle one only, so the first star finds no link to the others."""
    r = random.Random(3)
    base = [r.choice(vocabulary()) for _ in range(600)]

    def changed(seed):
        q, out = random.Random(seed), list(base)
        for at in q.sample(range(600), 12):
            out[at] = f"new{seed}x{at}"
        return " ".join(out)

    docs = [(i, changed(i)) for i in range(1, 30)] + [(50, " ".join(base))]
    same(minmax.near_duplicates(table(spark, docs), words=3, percent=85, rows=4), brute.near(docs))


def test_near_duplicates_measures_no_pairs_too_far_apart(spark, monkeypatch):
    """Every two of 60 variants meet in bands (similarity 0.7), but none are linked; only what the sketches allow is measured."""
    r = random.Random(7)
    base = [r.choice(vocabulary()) for _ in range(600)]
    docs = []
    for i in range(60):
        own = list(base)
        for at in r.sample(range(600), 20):
            own[at] = f"new{i}x{at}"
        docs.append((i, " ".join(own)))
    asked, measured = [], minmax._measured

    def spy(pairs, *more):
        asked.append(pairs.count())
        return measured(pairs, *more)

    monkeypatch.setattr(minmax, "_measured", spy)
    same(minmax.near_duplicates(table(spark, docs), words=3, percent=85, rows=4), brute.near(docs))
    assert sum(asked) < 60


def test_near_duplicates_of_an_id_with_several_texts(spark):
    """Id 50 stands on rows of four texts, each similar to that of one other document."""
    r = random.Random(41)
    docs = []
    for i in range(4):
        base = [r.choice(vocabulary()) for _ in range(300)]
        docs += [(50, " ".join(base)), (60 + i, " ".join([*base[:-1], "changed"]))]
    found = minmax.near_duplicates(table(spark, docs), words=3, percent=85, rows=4).select("doc_id", "component_id", "kept")
    same(found, [*[(50, 50, True)] * 4, *((60 + i, 50, False) for i in range(4))])


def test_near_duplicates_leaves_unwanted_texts_where_they_are(spark):
    """Two of 200 texts are asked for: no shuffle by doc_id moves all of them, whatever may be broadcast."""
    docs = [(i, f"text of its own {i}") for i in range(200)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        names = minmax._signatures(table(spark, docs).select("doc_id", "text"), 3, 4).filter("doc_id in (7, 9)").select("set_a", "doc_id")
        wanted = spark.createDataFrame(names.collect(), "member long, head long")
        found = minmax._class_texts(table(spark, docs).select("doc_id", "text"), wanted, 3)
        assert "hashpartitioning(doc_id" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(x.text for x in found.collect()) == ["text of its own 7", "text of its own 9"]
    finally:
        spark.conf.set(key, before)


def test_possibly_among_keeps_all_wanted(spark):
    rows = spark.range(20000).select(F.when(F.col("id") > 0, F.col("id")).alias("x"))
    wanted = rows.filter("x % 7 = 0 or x is null").withColumnRenamed("x", "y")
    kept = {r.x for r in possibly_among(rows, "x", wanted, "y").collect()}
    assert set(range(7, 20000, 7)) <= kept and None not in kept and len(kept) < 3000


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 125)] + [(1000, i) for i in range(1001, 1200)] + [(r.randrange(50), r.randrange(50)) for _ in range(30)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((x, root(x)) for x in linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", SETS)
def test_quality_counts(spark, name):
    docs = table(spark, SETS[name]).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    found = quality.quality_rules(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    wanted = []
    for doc, text in SETS[name]:
        counts = brute.quality_counts(text)
        wanted.append((doc, *counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0]))
    same(found, wanted)
    assert quality.passing(docs, labels).columns == docs.columns


def test_quality_counts_lines_of_many_texts_together():
    """Texts of one Arrow batch; some repeat their first line, some are empty or end with a line feed."""
    import pyarrow as pa

    from tidegauge.llm.text import utf8

    r = random.Random(31)
    texts = ["abc x", "def y\nzz\ndef y", None, "", "a\n", "\na\na", "a\n\na\n", " \n \nb", "\n"]
    for _ in range(300):
        own = [" ".join(r.choice("abc") for _ in range(r.randint(0, 3))) for _ in range(r.randint(1, 6))]
        texts.append("\n".join([*own, own[0]] if r.random() < 0.3 else own))
    r.shuffle(texts)
    found = quality.count_text(*utf8(pa.array(texts)))
    lines_of = [[line for line in (t or "").split("\n") if line.strip(" ")] for t in texts]
    assert found["n_lines"].tolist() == [len(own) for own in lines_of]
    assert found["n_dup_lines"].tolist() == [len(own) - len(set(own)) for own in lines_of]


def test_cutoffs_keep_their_promise():
    assert abs(quality.at_most(2, 10, 0.3) - 0.3827827864) < 1e-9
    r = random.Random(4)
    wrong = 0
    for _ in range(300):
        n, limit, level = 600, 0.02, 0.05
        values = [r.random() ** 3 for _ in range(n)]
        good = [*(sum(v > i / quality.BINS for v in values) for i in range(quality.BINS + 1)), n]
        bad = [*(1000 - i for i in range(quality.BINS + 1)), 1000]  # always worth another step
        cutoff = quality.choose_cutoff(good, [b + 10_000 * (200 - i) for i, b in enumerate(bad)], limit, level)
        wrong += cutoff is not None and 1 - cutoff ** (1 / 3) > limit
    assert wrong <= 300 * 0.05 + 12
    none = [0] * (quality.BINS + 1)
    assert quality.choose_cutoff([*none, 20], [*none, 20], 0.01, 0.01) is None
    assert quality.choose_cutoff([*none, 9000], [*none, 20], 0.01, 0.01) is None
    assert quality.choose_cutoff([*none, 9000], [20] * 101 + [*none[101:], 20], 0.01, 0.01) == 50 / quality.BINS


def test_quality_rejects_what_labels_allow(spark):
    r = random.Random(8)
    known = vocabulary()
    plain = [(i, " ".join(r.choice(known) for _ in range(40)), "en") for i in range(2500)]
    junk = [(10_000 + i, " ".join("#" + r.choice(known) + "|" for _ in range(40)), "en") for i in range(20)]
    docs = spark.createDataFrame(plain + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([*((i, 1) for i in range(2500)), *((10_000 + i, 0) for i in range(10))], "doc_id long, quality int")
    kept = {row.doc_id for row in quality.passing(docs, labels).collect()}
    assert kept == {i for i, _, _ in plain}


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_planes_round_trip(planes):
    r = np.random.default_rng(1)
    for ids in (np.zeros(0), np.zeros(5), r.integers(0, 50_257, 200_001), np.array([2**32 - 1, 0, 7])):
        ids = ids.astype(np.uint32)
        data = token_file.pack(ids, planes)
        assert (token_file.unpack(data) == ids).all()
        assert (token_file.unpack(data, 1, 2) == ids[token_file.BLOCK : 2 * token_file.BLOCK]).all()


ODD = ["it's a don't  x\n\n y", "  a", "a  ", "<|endoftext|> hi", "\t\tx", " \n z", "Ünï × ÷ 東京 12ab!!  ", "a\x0bb", "x \n\n  \n", "a\u00a0b ǅ"]


@pytest.mark.parametrize("name", SETS)
def test_token_files(spark, name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = [*SETS[name], *((100 + i, t) for i, t in enumerate(ODD))] if SETS[name] else []
    wanted = brute.token_rows(docs, Tokenizer.from_file(path), 2)
    found = token_file.token_digest(table(spark, docs), path, 2, 4)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))


def test_encoder_forgets_and_goes_on():
    import public_tokenizers

    encoder = token_file.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.KEEP = 3000
    texts = [t or "" for _, t in SETS["quotes"]]
    import pyarrow as pa

    from tidegauge.llm.text import utf8

    for start in range(0, len(texts), 20):
        part = texts[start : start + 20]
        ids, counts = encoder.encode(*utf8(pa.array(part)))
        wanted = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in part]
        assert ids.tolist() == [i for w in wanted for i in w] and counts.tolist() == list(map(len, wanted))


def test_packing(spark):
    r = random.Random(9)
    rows = [(i, r.choice([None, 0, 1, 50, 700, 3000]), r.choice(["hot", "hot", "a", None]), r.choice([1, 2, None, i])) for i in range(800)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, n long, source string, bin long")
    found = packing.pack(docs, F.col("n"), F.col("bin"), capacity=1000, per_source=2, group_tokens=200_000).collect()
    total = Counter()
    bins = defaultdict(list)
    for row in found:
        total[row.doc_id] += row.n_tokens
        if row.bin is not None:
            bins[row.bin_group, row.bin].append(row)
        else:
            assert row.n_tokens == (1000 if row.offset == 0 else 0)
    source, cluster = {d: s for d, _, s, _ in rows}, {d: c for d, _, _, c in rows}
    assert total == Counter({d: 2 * (n or 0) for d, n, _, _ in rows if n}) + Counter() or all(total[d] == 2 * (n or 0) for d, n, _, _ in rows)
    for members in bins.values():
        members.sort(key=lambda m: m.offset)
        ends = [m.offset + m.n_tokens for m in members]
        assert ends[-1] <= 1000 and [m.offset for m in members] == [0, *ends[:-1]]
        assert max(Counter(source[m.doc_id] for m in members).values()) <= 2
        clusters = [cluster[m.doc_id] for m in members if cluster[m.doc_id] is not None]
        assert len(clusters) == len(set(clusters))


def test_best_fit_takes_the_tightest_compatible_bin():
    placed = packing.best_fit([(6, "a", 1), (5, "b", 2), (4, "c", 1), (3, "d", 3), (2, "b", 4)], 10, 1)
    # 4 fits the bin of 6 exactly but shares its cluster; 2 fits the bins of 5 and of 6, the one of 5 has its source.
    assert placed == [(0, 0), (1, 0), (1, 5), (0, 6), (2, 0)]
    assert packing.pack


def test_toxicity_learns(spark):
    r = random.Random(11)
    plain = vocabulary()
    rows, labels = [], []
    for i in range(1200):
        words = [r.choice(plain) for _ in range(r.randint(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words[r.randrange(len(words))] = "grumbold" + r.choice("xyz")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = table(spark, [*rows, (None, None), (5000, "")])
    found = {x.doc_id: x for x in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert len(found) == 1202 and not found[5000].predicted and not found[None].held_out
    held = [(found[i].predicted, t) for i, t in labels if found[i].held_out]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    none = toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {x.score for x in none.collect()} == {0.0}
    assert toxicity.toxicity(table(spark, []), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_toxicity_model_holds_every_gram(spark):
    """Ratios of all labelled n-grams, of one document too, against plain Kneser-Ney sums."""
    import math

    def grams(text):
        out = set()
        for word in text.encode().split():
            row = b"    " + word + b" "
            out |= {row[i : i + 5] for i in range(len(row) - 4)}
        return out

    docs = [(0, "zorg plain words", 1), (1, "plain words here", 0), (4, "more plain words", 0), (5, "unlabelled zebra", None)]
    ids = {t: np.array([i for i, _, own in docs if own == t], np.int64) for t in (0, 1)}
    counts = toxicity._counts(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string"), ids)
    codes, ratios, contexts, free = toxicity._model(counts)
    every = set().union(*(grams(t) for _, t, _ in docs))
    of = {c: Counter(g for _, t, own in docs if own == c for g in grams(t)) for c in (1, 0)}
    cont = Counter(g[1:] for g in every)
    last = Counter(g[4:] for g in every)

    def shared(g):
        after = [n for c, n in cont.items() if c[:3] == g[1:4]]
        return (max(cont[g[1:]] - 0.75, 0) + 0.75 * len(after) * last[g[4:]] / len(every)) / sum(after)

    def parts(c, context):
        after = [n for g, n in of[c].items() if g[:4] == context]
        return sum(after), 0.75 * len(after) / sum(after) if after else 1.0

    wanted, rest = {}, {}
    for g in of[1].keys() | of[0].keys():
        p = []
        for c in (1, 0):
            total, backoff = parts(c, g[:4])
            p.append(max(of[c][g] - 0.75, 0) / max(total, 1) + backoff * shared(g))
        wanted[int.from_bytes(g, "big")] = math.log(p[0] / p[1])
        rest[int.from_bytes(g[:4], "big")] = math.log(parts(1, g[:4])[1] / parts(0, g[:4])[1])
    assert codes.tolist() == sorted(wanted) and contexts.tolist() == sorted(rest)
    assert np.allclose(ratios, [wanted[c] for c in codes.tolist()]) and np.allclose(free, [rest[c] for c in contexts.tolist()])
    assert all(wanted[int.from_bytes(g, "big")] > 0 for g in grams("zorg") if g[:4] != b"    ")


def test_winnowing(spark):
    words = vocabulary(3, 300)
    r = random.Random(12)
    items = [(i, " ".join(r.choice(words) for _ in range(n))) for i, n in enumerate([0, 1, 4, 12, 13, 14, 40, 40, 60])]
    items += [(20, items[6][1]), (21, None), (6, items[6][1])]
    docs = list(SETS["awkward"])
    for i in range(100, 160):
        own = [r.choice(words) for _ in range(r.randint(0, 200))]
        quote = r.choice(items)[1] or ""
        parts = quote.split(" ")
        a = r.randrange(len(parts))
        at = r.randint(0, len(own))
        own[at:at] = parts[a : a + r.randint(1, 30)]
        docs.append((i, " ".join(own).upper() if i % 3 else ",".join(own)))
    import hashlib
    import re

    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(text))

    windows = defaultdict(set)
    for item, text in items:
        w = cut(text)
        for s in range(max(1, len(w) - 12)) if w else ():
            windows[tuple(w[s : s + 13])].add(item)
    sizes = {len(w) for w in windows}
    wanted = []
    for doc, text in docs:
        w, hit, met = cut(text), set(), set()
        for m in sizes:
            for s in range(len(w) - m + 1):
                if tuple(w[s : s + m]) in windows:
                    hit.update(range(s, s + m))
                    met |= windows[tuple(w[s : s + m])]
        ids = sorted(map(str, met))
        wanted.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    same(winnow.judged(table(spark, docs), benchmark), wanted)
    clean = winnow.clean(table(spark, docs), benchmark)
    assert Counter(x.doc_id for x in clean.collect()) == Counter(x[0] for x in wanted if not x[5])
    assert winnow.judged(table(spark, []), benchmark).count() == 0
    assert winnow.judged(table(spark, docs), benchmark.limit(0)).filter("n_hit > 0").count() == 0


def variants(r, base, count, changes, name):
    """Lines of the words of ``base`` with some replaced by words of their own."""
    out = []
    for i in range(count):
        line = list(base)
        for at in r.sample(range(len(base)), r.choice(changes)):
            line[at] = f"{name}{i}x{at}"
        out.append(line)
    return out


def test_line_dedup_of_long_lines(spark):
    """Sets around the size from which sketches are wide, at similarities around the threshold."""
    r = random.Random(23)
    own = []
    for n, size in enumerate([94, 98, 102, 106, 150, 260, 400]):
        near = variants(r, [f"b{n}w{i}" for i in range(size)], 8, range(size // 14), f"v{n}")
        own += near + [x[: r.randint(len(x) * 9 // 10, len(x))] for x in near]
    r.shuffle(own)
    seen, wanted = [], []
    for i, line in enumerate(map(set, own)):
        wanted.append((i, not any(100 * len(line & s) >= 90 * len(line | s) for s in seen)))
        seen.append(line)
    assert 20 < sum(kept for _, kept in wanted) < 90
    same(lines.line_decisions(table(spark, [(i, " ".join(x)) for i, x in enumerate(own)])).select("doc_id", "kept"), wanted)


def test_line_dedup_makes_no_pairs_of_sets_too_far_apart(spark):
    """Every two of 60 variants of a line share most of their words, but none are similar enough; nor are lines that share words by chance."""
    r = random.Random(29)
    few = [f"w{i}" for i in range(300)]
    own = variants(r, [f"base{i}" for i in range(60)], 60, [5], "v") + [r.sample(few, 20) for _ in range(300)]
    docs = lines.with_text_key(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(own)], "doc_id long, text string"))
    found = lines.classes(lines.keyed_lines(docs, lines.rarity(docs), 90))
    posted = found.select("*", F.posexplode("prefix").alias("place", "token")).withColumn("place", F.col("place") + 1)
    assert lines._candidates(posted, posted, 90).count() < 20


def test_line_dedup_orders_tokens_by_a_small_table(spark):
    """The ranks fit a core's cache, the rarer word comes first, each word is one token, and a sketch tells sets apart by at most what differs."""
    docs = lines.with_text_key(spark.createDataFrame([(0, "often " * 500 + "seldom"), (1, "Often seldom often  rare1")], "doc_id long, text string"))
    ranks = lines.rarity(docs)
    masks = ranks.first()["ranks"]
    assert len(masks) == lines.BUCKETS and 8 * len(masks) <= 1 << 18
    rows = lines.with_tokens(lines.split_lines(docs), ranks).select("doc_id", "tokens", *lines.sketch(F.col("tokens"), F.size("tokens")))
    one, two = rows.orderBy("doc_id").collect()
    hashed = dict(spark.createDataFrame([("often",), ("seldom",), ("rare1",)], "w string").select("w", F.xxhash64("w")).collect())
    low = lambda x: x & ((1 << lines._HASH_BITS) - 1)
    assert [low(x) for x in one["tokens"]] == [low(hashed[w]) for w in ("seldom", "often")]
    assert [low(x) for x in two["tokens"]] == [low(hashed[w]) for w in ("rare1", "seldom", "often")]
    assert all(x >= 0 for x in two["tokens"]) and set(one["tokens"]) < set(two["tokens"])
    assert bin((one["folded"] ^ two["folded"]) & ((1 << 64) - 1)).count("1") == 1


def test_line_dedup_parts_words_at_every_break(spark):
    """A word between any two breaks is one word, and only a line feed ends a line."""
    lines_in = ["a\tb\x0bc\fd\re f", " a  b\t\tc \x0b d\r", "\r", " ", "A\u00a0B c", "a\u2028b"]
    wanted = sorted((0, i, len(set(brute.WORDS.findall(x.lower())))) for i, x in enumerate(lines_in))
    found = lines.line_decisions(table(spark, [(0, "\n".join(lines_in))])).select("doc_id", "line_no", "n_tokens")
    assert sorted(map(tuple, found.collect())) == wanted


def test_stored_leaves_no_shuffle_on_disk(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x.getName() for x in scala_list(blocks.getAllFiles()) if x.getName().startswith("shuffle_")}
    scala_list = lambda found: [found.apply(i) for i in range(found.size())]
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    found = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert not files() - before
    assert spark.conf.get(key, "false") == "false"
    assert found.count() == 7


@pytest.mark.parametrize("percent", [90, 80])
def test_line_dedup(spark, percent):
    r = random.Random(13)
    words = vocabulary(5, 400)
    base = [[r.choice(words) for _ in range(r.randint(1, 40))] for _ in range(30)]
    docs = []
    for i in range(80):
        own = []
        for _ in range(r.randint(0, 6)):
            line = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                line[r.randrange(len(line))] = r.choice(words)
            r.shuffle(line)
            own.append(" ".join(line))
        docs.append((i, "\n".join(own)))
    docs += [(200, None), (201, ""), (202, " \n\n"), (None, docs[5][1]), (203, docs[6][1].upper())]
    order = lambda row: (row[0] is not None, row[0] or 0)
    seen, wanted = [], []
    for doc, text in sorted(docs, key=order):
        for n, line in enumerate(text.split("\n") if text is not None else ()):
            tokens = set(brute.WORDS.findall(line.lower()))
            match = any(100 * len(tokens & s) >= percent * len(tokens | s) for s in seen) if tokens else False
            wanted.append((doc, n, len(tokens), not match))
            if tokens:
                seen.append(tokens)
    found = lines.line_decisions(table(spark, docs), percent)
    same(found.select("doc_id", "line_no", "n_tokens", "kept"), wanted)
    kept = defaultdict(list)
    for doc, n, _, keep in wanted:
        if keep:
            kept[doc].append(dict(docs)[doc].split("\n")[n])
    reduced = lines.without_repeats(table(spark, docs), percent)
    assert {x.doc_id: x.text for x in reduced.collect()} == {d: None if t is None else "\n".join(kept[d]) for d, t in docs}
    assert lines.line_decisions(table(spark, [])).count() == 0


def test_line_dedup_of_rows_with_equal_ids(spark):
    """Rows of one id, null or not, with different texts: each loses its own repeated lines and no other's."""
    first, second = "one two three", "once upon a time"
    docs = [
        (None, f"alpha beta\n{first}\ngamma delta"), (None, f"epsilon zeta\neta theta\n{first}"), (None, "iota kappa\nlambda mu\nnu xi"),
        (7, f"{second}\nomicron pi"), (7, f"{second}\nrho sigma"), (7, f"{second}\nrho sigma"),
    ]
    reduced = [(x.doc_id, x.text) for x in lines.without_repeats(table(spark, docs)).collect()]
    assert {t for d, t in reduced if d is None} == {docs[0][1], "epsilon zeta\neta theta", docs[2][1]}
    # Which of the two texts stays whole is up to their hashes; the repeated row is treated as its copy.
    own = Counter(t for d, t in reduced if d == 7)
    assert own in (Counter({docs[3][1]: 1, "rho sigma": 2}), Counter({"omicron pi": 1, docs[4][1]: 2}))


def test_line_dedup_verifies_the_line_of_each_row(spark):
    """Similar, not equal lines, whose rows share id and line number with other lines."""
    r = random.Random(17)
    base = [r.choice(vocabulary()) for _ in range(60)]
    docs = []
    for i in range(20):
        line = list(base) if i % 2 else [r.choice(vocabulary()) for _ in range(60)]
        line[i] = f"only{i}"
        docs.append((None if i < 10 else 5, " ".join(line)))
    kept = lines.without_repeats(table(spark, docs)).filter("text != ''").count()
    assert kept == 11


def test_urls(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/de/", "block")]
    rows = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.ORG/en/12?x#y"), (5, "http://a.example.org"), (6, "http://example.org/es/1"),
        (7, "https://x.com/de/1#q"), (8, "http://notorg/es/"), (9, "http://a.example.org/es"), (10, "x://y://z/"),
        *((100 + i, f"http://x.com/de/a/{i}") for i in range(40)), *((200 + i, f"http://x.net/de/a/{i}") for i in range(40)),
        *((300 + i, f"http://x.net/ok/a/b/c/d/{i}") for i in range(40)), *((400 + i, f"http://y.org/ok/{i}") for i in range(60)),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "template": F.lit(2)})
    found = {x.page_id: x for x in urls.filter_urls(pages, rules).collect()}
    assert len(found) == len(rows)
    assert [(found[i].host, found[i].path, found[i].rule) for i in range(1, 11)] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.example.org", "/en/12", "example.org/en/1"), ("a.example.org", "", None),
        ("example.org", "/es/1", "example.org/es/"), ("x.com", "/de/1", "com/de/"), ("notorg", "/es/", None),
        ("a.example.org", "/es", "org/"), ("y:", "//z/", None),
    ]
    assert found[4].verdict == "block" and found[9].verdict == "allow"
    # The template that is always blocked on one host is blocked on another without labels; others are not.
    assert {found[200 + i].verdict for i in range(40)} == {"block"} and {found[300 + i].verdict for i in range(40)} == {"allow"}
    assert found[200].template == "/de/a/*" and found[300].template == "/ok/a/b/c/**"
    assert urls.filter_urls(pages.limit(0), rules).count() == 0
