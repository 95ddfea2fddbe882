"""The pipeline against plain versions of its stages."""

import random
import sys
from collections import Counter
from pathlib import Path

import brute

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402


def plain_lines(docs, percent=90):
    seen, out = [], []
    for doc, text in docs:
        kept = []
        for line in text.split("\n"):
            tokens = set(brute.WORDS.findall(line.lower()))
            if tokens and any(100 * len(tokens & s) >= percent * len(tokens | s) for s in seen):
                continue_line = False
            else:
                continue_line = True
            if tokens:
                seen.append(tokens)
            if continue_line:
                kept.append(line)
        out.append((doc, "\n".join(kept)))
    return out


def contaminated(text, items):
    import re

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(t))
    windows = {tuple(w[i : i + 13]) for w in map(cut, items) for i in range(len(w) - 12)}
    w, hit = cut(text), set()
    for i in range(len(w) - 12):
        if tuple(w[i : i + 13]) in windows:
            hit.update(range(i, i + 13))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_pipeline(spark, tmp_path):
    r = random.Random(21)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [line(30) for _ in range(6)]
    footer = line(12)
    docs = []
    for i in range(70):
        lines = [line(r.randint(10, 40)) for _ in range(r.randint(1, 5))]
        if i % 7 == 0:
            lines.append(footer)
        if i % 10 == 3:
            lines.insert(0, r.choice(items))
        if i % 9 == 4:
            lines = docs[i - 4][1].split("\n")
        if i % 9 == 5:
            words = docs[i - 2][1].split(" ")
            words[r.randrange(len(words))] = "changed"
            lines = " ".join(words).split("\n")
        docs.append((i, "\n".join(lines)))
    docs += [(100, "too short"), (101, " ".join(["again and"] * 60)), (102, line(25) + "\n" + line(4))]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in docs] + [(200, None, None, None, None), (201, "", "en", "s0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (100, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    wanted = []
    for doc, text in docs:
        counts = brute.quality_counts(text)
        if counts[0] >= 20 and 100 * counts[4] <= 30 * counts[0]:
            wanted.append((doc, text))
    assert 40 < len(wanted) < len(docs)
    wanted = plain_lines(wanted)
    groups = {d for d, _, _, kept in brute.near(wanted, 5, 80) if kept}
    wanted = [(d, t) for d, t in wanted if d in groups and not contaminated(t, items)]
    sizes = {d: len(brute.WORDS.findall(t)) for d, t in wanted}

    current = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, current, str(tmp_path)).columns == current.columns, name
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    total = Counter()
    for row in found:
        total[row.doc_id] += row.n_tokens
    assert set(total) == set(sizes) and all(total[d] == sizes[d] for d in sizes)
