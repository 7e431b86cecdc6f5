"""Importance resampling and every pipeline stage, computed plainly over small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from metaferry.llm import importance, shingles
from tests.llm.test_near_dedup import expected as near_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns of documents, and some whose names the stages use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, print int, size int, notes string"


def plain_buckets(text):
    """Words, and pairs of neighbours, hashed one by one."""
    hashes = [int(shingles.word_hashes(word)[0]) for word in WORD.findall((text or "").lower())]
    pair = lambda a, b: int(shingles.mixed(np.array([(a * 0x9E3779B97F4A7C15 + b) % 2**64], np.uint64))[0])
    return [h % importance.BUCKETS for h in [*hashes, *(pair(a, b) for a, b in zip(hashes, hashes[1:]))]]


def test_importance_resampling(spark):
    dice = random.Random(12)
    vocabulary = [f"v{k}" for k in range(40)]
    texts = [" ".join(dice.choice(vocabulary[: dice.choice([8, 40])]) for _ in range(dice.choice([1, 5, 60]))) for _ in range(90)]
    texts += [None, "", " \n", "Case CASE case", texts[3], texts[3], "long " * 100_000]
    rows = [(k, text) for k, text in enumerate(texts)] + [(None, texts[5]), (4, texts[4]), (None, texts[5])]
    docs = spark.createDataFrame([(key, text, 1.0) for key, text in rows], "doc_id long, text string, log_weight double")
    labels = [(k, int(k % 3 > 0)) for k in range(0, 90, 2)] + [(92, 1), (None, 1), (500, 1), (7, None)]
    found = importance.resampled(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()

    good = {key for key, quality in labels if quality == 1 and key is not None}
    raw, target = Counter(), Counter()
    for key, text in rows:
        raw.update(plain_buckets(text))
        if key in good:
            target.update(plain_buckets(text))
    scale, n = sum(target.values()) / sum(raw.values()), importance.BUCKETS * importance.PRIOR
    total_target, total_raw = sum(target.values()) + n, sum(raw.values()) * scale + n

    def weight(text):
        return sum(
            math.log((target[b] + importance.PRIOR) / total_target) - math.log((raw[b] * scale + importance.PRIOR) / total_raw)
            for b in plain_buckets(text)
        )

    assert len(found) == len(rows)
    wanted = defaultdict(list)
    for key, text in rows:
        wanted[key].append((len(plain_buckets(text)), weight(text)))
    seen = defaultdict(list)
    for row in found:
        seen[row.doc_id].append((row.n_features, row.log_weight))
    for key, values in wanted.items():
        for (n_seen, w_seen), (n_wanted, w_wanted) in zip(sorted(seen[key]), sorted(values)):
            assert n_seen == n_wanted and w_seen == pytest.approx(w_wanted, rel=1e-6, abs=1e-6)
    noise = {row.doc_id: row.g for row in docs.select("doc_id", importance.gumbel("doc_id").alias("g")).collect()}
    for row in found:
        assert row.priority == pytest.approx(row.log_weight + noise[row.doc_id])
    known = [quality for _, quality in labels if quality is not None]
    k = math.ceil(len(rows) * sum(known) / len(known))
    least = sorted((row.priority for row in found), reverse=True)[k - 1]
    assert all(row.kept == (row.priority >= least) for row in found)


def rejected(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) for j in range(3) if windows[tuple(words[k : k + 3])] > 1}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    characters, n = sum(map(len, words)), len(words)
    return (
        n < 50 or 2 * len(covered) > n or 10 * len(re.findall(r"[#*$%&|<>]", text or "")) > 3 * n
        or 2 * (len(lines) - len(set(lines))) > len(lines) or characters < 2 * n or characters > 15 * n
    )


def small_documents():
    dice = random.Random(13)
    word = lambda: "".join(dice.choice("abcdefghé") for _ in range(dice.choice([3, 5, 7])))
    rows = []

    def add(text, source=None, key=None):
        number = 1000 + len(rows) if key is None else key
        rows.append((number, text, "en", source, len(text) if text is not None else None, "x", 5, 6, "n"))

    for k in range(70):
        lines = [" ".join(word() for _ in range(dice.choice([8, 15]))) for _ in range(dice.choice([3, 7, 12]))]
        if k % 4 == 0:
            lines.insert(dice.randrange(len(lines)), "read more about this site")
        add("\n".join(lines), ["a", "a", "b", None][k % 4])
        if k % 9 == 0:
            copy = rows[-1][1].split(" ")
            copy[len(copy) // 2] = "changed"
            add(" ".join(copy), "b")
            add(rows[-2][1], "a")
    for text in (None, "", "too short", "same words again " * 40, "# $ " * 60, "x " * 80, "y" * 500_000):
        add(text, "c")
    add(rows[0][1], "a", rows[0][0])  # a wholly identical row
    add(" ".join(word() for _ in range(60_000)), "c")  # a very long text
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(small_documents(), DOCS).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tables = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{number}"
        stage(spark, tables[-1], folder).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return folder, tables


def rows_of(table, *columns):
    return sorted((tuple(row) for row in (table.select(*columns) if columns else table).collect()), key=str)


def test_quality_stage(stages):
    before, after = stages[1][:2]
    assert after.columns == before.columns
    assert rows_of(after) == sorted((row for row in rows_of(before) if not rejected(row[1])), key=str)
    assert 0 < after.count() < before.count()


def test_line_stage(stages):
    before, after = stages[1][1:3]
    rows = rows_of(before)
    pages, held = Counter(row[3] for row in rows), Counter()
    for row in rows:
        held.update({(row[3], line) for line in row[1].split("\n") if WORD.search(line)})
    wanted = []
    for row in rows:
        lines = row[1].split("\n")
        kept = [x for x in lines if not (held[row[3], x] >= 3 and 100 * held[row[3], x] > pages[row[3]])]
        text = "\n".join(kept)
        wanted.append((row[0], text, *row[2:4], len(text) if len(kept) < len(lines) else row[4], *row[5:]))
    assert rows_of(after) == sorted(wanted, key=str)
    assert rows_of(after) != rows


def test_near_duplicate_stage(stages):
    before, after = stages[1][2:4]
    component = near_components([(row[0], row[1]) for row in rows_of(before)])
    kept = [row[0] for row in rows_of(after)]
    assert sorted(kept) == sorted({key for key, label in component.items() if key == label})
    assert set(rows_of(after)) <= set(rows_of(before)) and after.count() < before.count()


def test_mixing_stage(stages):
    before, after = stages[1][3:5]
    size = lambda row: len(WORD.findall(row[1] or ""))
    times, rows = Counter(rows_of(after)), rows_of(before)
    assert set(times) <= set(rows) and max(times.values()) <= 3
    own, taken = Counter(), Counter()
    for row in rows:
        own[row[3]] += size(row)
        taken[row[3]] += size(row) * times[row]
    weight = {name: (5, 2, 1)[k % 3] for k, name in enumerate(sorted(own, key=lambda s: (s is None, s or "")))}
    target, open_ones = {}, set(own)
    while open_ones:  # what a full source leaves is shared again
        rest, weights = sum(own.values()) - sum(target.values()), sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if rest * weight[s] / weights > 3 * own[s]}
        target |= {s: 3 * own[s] for s in full} if full else {s: rest * weight[s] / weights for s in open_ones}
        open_ones = open_ones - full if full else set()
    longest = {s: max(size(row) for row in rows if row[3] == s) for s in own}
    for s in own:  # a document is taken as a whole
        assert abs(taken[s] - target[s]) <= max(2 * longest[s], 0.1 * target[s]), s


def test_encoding_stage_and_run(spark, stages):
    folder, tables = stages
    before, after = tables[4:6]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for doc_id, text in rows_of(before, "doc_id", "text"):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.append((doc_id, ids, len(ids), hashlib.sha256(decoded.encode()).hexdigest()))
    assert rows_of(after, "doc_id", "ids", "n_tokens", "decoded_sha256") == sorted(wanted, key=str)
    columns = [F.col(name) for name in after.columns]
    assert rows_of(corpus_pipeline.run(spark, folder), *columns) == rows_of(after, *columns)


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
