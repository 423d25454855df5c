"""Every operator on awkward rows, and against brute force where SQL cannot say it."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from groundhold.llm import (
    content_sort,
    license_classifier,
    line_edit_join,
    mixing,
    packing,
    queries,
    recurrent_lm,
    risk_quality,
    sentence_spans,
    set_sketch,
    warc_derivatives,
)
from groundhold.llm.graph import connected_components

SF = "/root/testdata/sf0.001"
TOKENIZER = {k: public_tokenizers.path(f"byte_bpe_50k.{v}") for k, v in (("tokenizer", "json"), ("ranks", "tiktoken"))}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row long, n long, key string"


def docs(spark, texts):
    rows = [(i, t, None if i == 1 else "en", None if i == 2 else f"s{(i or 0) % 2}", 0, 5, 5, 5, "k") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def awkward(spark):
    """Null, empty, blank, long, equal and repeated rows; a repeated and a null id; extra columns with plain names."""
    long = " ".join(f"word{i}." for i in range(3000))
    texts = [(0, None), (1, ""), (2, " \n\t"), (3, long), (4, long), (4, long), (5, "a  b"), (6, "a\nb"), (None, "x y z"), (None, None)]
    return docs(spark, texts)


OPERATORS = {
    "op1": recurrent_lm.score_documents,
    "op2": line_edit_join.line_classes,
    "op3": sentence_spans.cut_passages,
    "op5": content_sort.exact_groups,
    "op7": license_classifier.licences,
    "op8": mixing.mix,
    "op9": set_sketch.near_duplicates,
    "op10": lambda d: packing.pack(d, **TOKENIZER),
}


def quality(d):
    labels = d.sparkSession.createDataFrame([(3, 1), (4, 0), (4, None), (99, 1)], "doc_id long, quality int")
    return risk_quality.judge(d, labels)


@pytest.mark.parametrize("name", ["op1", "op3", "op5", "op6", "op7", "op8", "op9"])
def test_awkward_rows_are_all_there(spark, awkward, name):
    found = (OPERATORS | {"op6": quality})[name](awkward)
    assert found.count() == awkward.count()


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op5", "op6", "op7", "op8", "op9", "op10"])
def test_empty_table(spark, awkward, name):
    assert (OPERATORS | {"op6": quality})[name](awkward.limit(0)).isEmpty()


def test_exact_groups(awkward):
    kept = {(r.doc_id, r.keep_id, r.group_size) for r in content_sort.exact_groups(awkward).collect() if r.kept}
    assert kept == {(0, 0, 3), (2, 2, 1), (3, 3, 3), (5, 5, 2), (None, None, 1)}
    assert content_sort.drop_copies(awkward).count() == 5


def test_within_agrees_with_distance(spark):
    rng, rows = random.Random(1), []
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(3, 30)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randrange(len(b) + 1), "c") if rng.random() < 0.5 else b.pop(rng.randrange(len(b)))
            b = b or ["a"]
        a, b = sorted((a, "".join(b)), key=len)
        k = rng.choice([1, 2])
        if len(b) - len(a) <= k <= len(a):
            rows.append((a, b, k))
    pairs = spark.createDataFrame(rows, "a string, b string, k int").select(
        "*", F.split("a", "").alias("x"), F.split("b", "").alias("y"), F.char_length("a").alias("n"), F.char_length("b").alias("m")
    )
    pairs = pairs.withColumns(line_edit_join.bands(F.col("k"), F.col("n")))
    assert pairs.filter(line_edit_join.within("x", "y", "n", "m", "k") != (F.levenshtein("a", "b") <= F.col("k"))).isEmpty()


def test_line_links(spark):
    base = "the quick brown fox jumps over the lazy dog again"
    d = docs(spark, [(0, base), (1, base.replace("quick", "quack")), (2, base[1:] + "st"), (3, "short"), (4, "shirt"), (5, base)])
    found = {r.doc_id: (r.class_doc, r.n_links, r.kept) for r in line_edit_join.line_classes(d).collect()}
    assert found[0] == (0, 1, True) and found[1] == (0, 1, False) and found[5] == (0, 1, False)
    assert found[2] == (2, 0, True) and found[3] == (3, 0, True) and found[4] == (4, 0, True)


def test_passages(spark):
    passage = "One two three four five six. Seven eight nine ten eleven. Twelve thirteen fourteen fifteen. Sixteen to twenty is it."
    d = docs(spark, [(0, f"First. {passage}"), (1, f"Other words here.\n{passage}\nAn end of its own."), (2, "Nothing. Like. It.")])
    left = {r.id: r.text for r in sentence_spans.cut_passages(d).collect()}
    assert left == {0: f"First. {passage}", 1: "Other words here.\nAn end of its own.", 2: "Nothing. Like. It."}


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [(0, "http://a/", "<html lang=en><title>T &amp; x</title><p>one<b>two</b><script>no</script><br>three <a href=/z>l</a>"),
         (1, None, None), (None, "http://b/", "")], "page_id long, url string, html string",
    )
    derived = warc_derivatives.derive(warc_derivatives.responses(pages, "2025-01-01T00:00:00Z"))
    warc_derivatives.write_records(derived, str(tmp_path / "w"))
    read = warc_derivatives.read_records(spark, str(tmp_path / "w")).collect()
    assert len(read) == 6 and all(warc_derivatives.digest(bytes(r.block)) == r.headers["warc-block-digest"] for r in read)
    texts = [bytes(r.block) for r in read if r.headers["warc-type"] == "conversion" and r.headers.get("warc-target-uri") == "http://a/"]
    assert texts == [b"onetwo\nthree l"]
    assert warc_derivatives.derive(warc_derivatives.responses(pages.limit(0), "d")).isEmpty()


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base, texts = [rng.choice(words) for _ in range(120)], []
    for i in range(60):
        own = [rng.choice(words) if rng.random() < 0.004 * (i % 12) else w for w in base]
        texts.append((i, " ".join(own if i < 50 else [rng.choice(words) for _ in range(100)])))
    found = {r.doc_id: r.component_id for r in set_sketch.near_duplicates(docs(spark, texts)).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in texts}
    group = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    assert found == group


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 20)] + [(30, 31), (5, 5), (None, 2)], "a long, b long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {**dict.fromkeys(range(21), 0), 30: 30, 31: 30}


def test_token_ids_and_offsets(spark, awkward):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(TOKENIZER["tokenizer"])
    texts = ["a  b", "x\n\ny", " lead", "it's\nwe'll 12 é", "<|endoftext|> z", "tab\tbed", "", "one two\nthree"]
    ids = packing.WordIds(**{"path": TOKENIZER["tokenizer"], "ranks": TOKENIZER["ranks"]})(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [exact.encode(t, add_special_tokens=False).ids for t in texts]
    rows = packing.pack(awkward, **TOKENIZER).collect()
    by = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert by[r.sequence_id] == r.offset
        by[r.sequence_id] += r.length
    assert max(by.values()) <= 1024
    assert next(r.ids_crc32 for r in rows if r.doc_id == 1) == zlib.crc32(np.array([2], "<u4").tobytes())


def test_model_gradient():
    rng = np.random.default_rng(0)
    model = recurrent_lm.Model((rng.standard_normal(recurrent_lm.Model().flat.size) * 0.2).astype(np.float64))
    x, y = rng.integers(0, 1050, (5, 3)), rng.integers(0, 1050, (5, 3))
    fresh, live, h = np.zeros((5, 3), bool), np.ones((5, 3), bool), np.zeros((3, recurrent_lm.HIDDEN))
    fresh[0], fresh[3, 1] = True, True
    grad, _ = model.gradient(x, y, fresh, live, h)

    def loss(flat):
        m = recurrent_lm.Model(flat)
        return -m.log_probabilities(m.states(x, fresh, h).reshape(-1, recurrent_lm.HIDDEN), y.ravel()).mean()

    for i in np.argsort(-np.abs(grad))[:8]:
        step = np.zeros_like(model.flat)
        step[i] = 1e-3
        assert abs((loss(model.flat + step) - loss(model.flat - step)) / 2e-3 - grad[i]) < 1e-3


def test_mix_stage_holds_what_the_mix_takes(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixing.mix(table).collect()}
    held = Counter()
    for r in mixing.mixed_documents(table).collect():
        held[r.doc_id] += len((r.text or "").encode().split())
    assert {k: v for k, v in taken.items() if v} == dict(held)


def test_pipeline_runs_and_packs(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    assert found and max(r.offset + r.length for r in found) <= 1024
    assert len(corpus_pipeline.STAGES) == 5


def test_licences_on_the_tables(spark):
    found = queries.op7_license_classifier(spark, SF)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    planted = table.filter(F.col("text").rlike("(?m)^(Licensed under|Released under the MIT|This work is licensed)[^\\n]*$")).count()
    assert found.filter("licence is not null and licence <> 'reserved'").count() == planted


def test_weights_see_every_training_document(spark):
    """Only the order of one document's words differs: counts agree, so a score can differ by the weights alone."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2 and zlib.crc32(str(i).encode()) // 7 % 16][:6]
    held = next(i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2)
    text = " ".join(f"w{i % 7} w{i % 5}" for i in range(60))
    for turned in (ids[0], ids[-1]):
        scores = []
        for own in (text, " ".join(sorted(text.split()))):
            rows = [(i, own if i == turned else text) for i in ids] + [(held, text)]
            found = {r.doc_id: r for r in recurrent_lm.score_documents(docs(spark, rows).coalesce(1)).collect()}
            scores.append((found[held].base_score, found[held].score))
        assert scores[0][0] == scores[1][0] and abs(scores[0][1] - scores[1][1]) > 1e-6


def test_line_links_follow_the_length(spark):
    """Lines of 16 to 2,000 characters with changed words and stray edits, against the distance of every pair."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    lines = []
    for size in (3, 5, 8, 12, 20, 30, 45, 60, 90, 110, 330):
        own = [rng.choice(vocabulary) for _ in range(size)]
        lines.append(" ".join(own))
        for changes in (1, 1, size // 15, size // 8, size // 4):
            words = list(own)
            for _ in range(changes):
                words[rng.randrange(size)] = rng.choice(vocabulary)
            line = list(" ".join(words))
            for _ in range(rng.randint(0, size // 6)):
                at = rng.randrange(len(line))
                line[at : at + 1] = rng.choice((["x", line[at]], [], ["y"]))
            lines.append("".join(line))
    lines = sorted(set(lines))
    table = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "id long, line string, n int")
    left, right = (table.select(*[F.col(c).alias(c + s) for c in table.columns]) for s in "xy")
    every = left.join(right, (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("idx") < F.col("idy"))))
    allowed = F.greatest(F.least(F.floor(F.col("nx") / 16), F.lit(2)), F.floor(F.col("nx") / 17))
    near = every.filter((F.levenshtein("linex", "liney") <= allowed) & (F.col("nx") >= 16))
    expected = {(r.idx, r.idy) for r in near.collect()}
    assert {(r.x, r.y) for r in line_edit_join.edit_links(table).collect()} == expected
    assert sum(len(lines[x]) >= 48 for x, _ in expected) > 20 and any(len(lines[x]) > 512 for x, _ in expected)
    text = "a line of some three hundred characters in which a single word is not the same " * 4
    found = line_edit_join.line_classes(docs(spark, [(0, text), (1, text.replace("single", "lonesome", 1))]))
    assert {(r.doc_id, r.class_doc, r.n_links) for r in found.collect()} == {(0, 0, 1), (1, 0, 1)}


def test_line_keys_are_not_shuffled(spark, monkeypatch):
    """Stretches of the lines are dealt out, a few times their text at most; windows of one character each are not."""
    rng, plans = random.Random(6), []

    def kept(df, name, write=line_edit_join.materialize):
        if name == "line-pairs":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(line_edit_join, "materialize", kept)
    lines = ["".join(rng.choice("abcdefgh é𝄞") for _ in range(n)) for n in range(20, 900, 40)]
    lines += [x[: len(x) // 2] + "Z" + x[len(x) // 2 + 1 :] for x in lines]
    rows = [(i, x, len(x)) for i, x in enumerate(lines)]
    table = spark.createDataFrame(rows + rows, "id long, line string, n int")
    half = len(lines) // 2
    assert {(r.x, r.y) for r in line_edit_join.edit_links(table).collect()} == {(i, i + half) for i in range(half)}
    assert len(plans) == 1 and "hashpartitioning(key" not in plans[0] and ", key#" not in "".join(
        x for x in plans[0].split("\n") if "Exchange" in x
    )
    monkeypatch.undo()
    whole = {(r.x, r.y) for r in line_edit_join.candidates(table).collect()}
    monkeypatch.setattr(line_edit_join, "CHARS_PER_SHARE", 8000)
    assert {(r.x, r.y) for r in line_edit_join.candidates(table).collect()} == whole
    sent = line_edit_join.stretches(table).agg(F.sum(F.char_length("part"))).first()[0]
    assert sent < 3 * sum(map(len, lines))


def test_passages_inside_long_sentences(spark):
    """Passages that begin and end mid-sentence, behind heads of every length, against a search for shared stretches."""
    rng = random.Random(4)
    fresh = iter(f"{rng.choice('abcdefgh')}{i}" for i in range(100_000))
    texts, passages = [], []
    for k in range(40):
        size = 60 + k % 30
        passage = [next(fresh) for _ in range(size)]
        if k % 4 == 1:
            passage[size // 2] += "."
        if k % 4 == 2:
            passage = [rng.choice(("to", "be", "or")) if rng.random() < 0.5 else w for w in passage]
        passages.append(passage)
        for n in (k % 17, 5 + k % 13):
            texts.append([next(fresh) for _ in range(n)] + passage + [next(fresh) for _ in range(3 + k % 11)])
    table = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    found = {r.id: r for r in sentence_spans.cut_passages(table).collect()}
    stretches: dict[tuple, int] = {}
    for i, words in enumerate(texts):
        for at in range(len(words) - 19):
            stretches.setdefault(tuple(words[at : at + 20]), i)
    for i, words in enumerate(texts):
        repeated = {p for at in range(len(words) - 19) if stretches[tuple(words[at : at + 20])] < i for p in range(at, at + 20)}
        left = found[i].text.split()
        assert found[i].removed_words == len(words) - len(left) <= len(repeated)
        kept = Counter(left)
        kept.subtract(words[p] for p in range(len(words)) if p not in repeated)
        assert min(kept.values()) >= 0
        assert (found[i].removed_words >= 20) == bool(repeated)
    pieces = sentence_spans.Sentences(3, 20, 12)
    for words in texts:
        assert np.diff(pieces.cut(" ".join(words))[0]).max() <= 12


def test_wrapped_notices(spark):
    """Hard-wrapped notices among prose of the tables, with and without blank lines around them."""
    import textwrap

    full = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice",
        "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    }
    prose = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").orderBy("doc_id").limit(60).select("text").collect()
    lines = [x for r in prose for x in r.text.split("\n") if 30 < len(x) < 90][:24]
    texts = []
    for width in (70, 80):
        for name, text in full.items():
            body = "\n".join(textwrap.wrap(text, width))
            texts += [(name, body), (name, f"{lines[0]}\n\n{body}\n\n{lines[1]}"), (name, "\n".join((*lines[2:5], body, *lines[5:8])))]
    plain = [(100 + i, x) for i, x in enumerate(lines)]
    table = docs(spark, [(i, t) for i, (_, t) in enumerate(texts)] + plain + [(99, license_classifier.TEMPLATES["mit"][1] + "\nand\nmore")])
    found = {r.doc_id: (r.licence, r.n_licences) for r in license_classifier.licences(table).collect()}
    assert {i: found[i] for i in range(len(texts))} == {i: (name, 1) for i, (name, _) in enumerate(texts)}
    assert found[99] == ("mit", 1) and all(found[i][1] == 0 for i, _ in plain)


def test_small_sources_get_their_target(spark):
    """Sources of 10 and 30 words beside large ones: each is taken three times, its blocks counted by their own words."""
    sizes = {"a": 10, "b": 30, "c": 200_000, "d": 90_000, "e": 65}
    rows = []
    for source, n in sizes.items():
        for at in range(0, n, 997):
            rows.append((len(rows), " ".join(["w"] * min(997, n - at)), "en", source, 0, 5, 5, 5, "k"))
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA), shard_words=20_000).collect()
    source = {r[0]: r[3] for r in rows}
    taken, target = Counter(), {}
    for r in found:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert (taken["a"], taken["b"]) == (30, 90) == (target["a"], target["b"])
    assert all(abs(taken[s] - target[s]) <= 64 * max(1, n / 20_000) for s, n in sizes.items())


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(8)
    for seats in (3, 40, 300):
        votes = [rng.choice([0.2, 0.5, 1.0, rng.random() * 5, rng.random() * seats]) for _ in range(40)]
        most = [3 * max(1, round(v)) for v in votes]
        parties = spark.createDataFrame([(0, i, v, m) for i, (v, m) in enumerate(zip(votes, most))], "no int, shard int, votes double, most long")
        got = {r.shard: r.quota for r in mixing.apportion(parties, ["no", "shard"]).collect()}
        quotients = sorted((-v / (2 * s + 1), i, s) for i, (v, m) in enumerate(zip(votes, most)) for s in range(m))
        won = Counter(i for _, i, _ in quotients[: round(sum(votes))])
        assert got == {i: won[i] for i in range(40)}


FOREIGN = [
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "This work is licensed under the GNU General Public License, version 2.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "Licensed under the Apache License, Version 1.1.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "Licensed under the BSD 2-Clause License.",
    "Released under the MPL License.",
    "Released under the ISC License.",
    "Licensed under CC BY 3.0.",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.",
    "Licensed under CC BY-SA 4.0.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Licensed under CC BY-NC-ND 4.0.",
    "This program is free to read: you can look at it and think about it in the terms of a general reader",
]
OWN = {
    "apache-2.0": ["licensed under the apache license, version 2.0", "// Licensed under the Apache License, Version 2.0 (see LICENSE)."],
    "bsd-3-clause": ["Licensed under the BSD 3-Clause License!"],
    "cc-by-4.0": ["Text licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International Licence."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License,  version 3.", "This program is free software: you can redistribute it "
                "and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "mit": ["Released under the MIT License."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "reserved": ["All rights reserved."],
}


def test_relatives_of_the_families_are_unknown(spark):
    """Precision and recall per family: notices of families that the classifier was never shown, and of its own."""
    prose = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").orderBy("doc_id").limit(60).select("text").collect()
    rows = [(i, t) for i, t in enumerate(FOREIGN)] + [(100 + i, t) for i, t in enumerate(t for texts in OWN.values() for t in texts)]
    names = [name for name, texts in OWN.items() for _ in texts]
    table = docs(spark, rows + [(1000 + i, r.text) for i, r in enumerate(prose)])
    found = {r.doc_id: r.licence for r in license_classifier.licences(table).filter("doc_id < 1000").collect()}
    wrong = {FOREIGN[i]: found[i] for i in range(len(FOREIGN)) if found[i] is not None}
    assert not wrong
    assert {i: found[100 + i] for i in range(len(names))} == dict(enumerate(names))


def test_language_model_against_plain_loops(spark):
    """The base scores against plain counts, the model's against one step at a time with whole sums over all words of a class."""
    rng = random.Random(11)
    words = [f"w{int(rng.paretovariate(0.35))}" for _ in range(9000)]
    rows = [(i, " ".join(words[at : at + 60 * (i % 3)])) for i, at in enumerate(range(0, 9000, 60))] + [(150, None), (151, "New Words new")]
    table = docs(spark, rows)
    found = {r.doc_id: r for r in recurrent_lm.score_documents(table).collect()}
    texts = {i: (t or "").lower().split() + ["\n"] for i, t in rows}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, t in texts.items() if i not in held for w in t)
    n, v = sum(counts.values()), len(counts)
    assert v > 1100 and held == {i for i, r in found.items() if r.held_out}
    for i, text in texts.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in text)
        row = (found[i].n_tokens, found[i].n_known, found[i].train_tokens)
        assert row == (len(text), sum(counts[w] > 0 for w in text), n) and abs(found[i].base_score - base) < 1e-8
        assert math.isfinite(found[i].score) and found[i].score < 0

    numbered = table.select(F.col("doc_id").alias("__row"), F.col("doc_id").alias("id"), "text", recurrent_lm.fold("doc_id").alias("fold"))
    frame = recurrent_lm.word_counts(numbered.filter("fold % 7 <> 2"))
    vocabulary = recurrent_lm.vocabulary(frame)
    flat = np.random.default_rng(3).standard_normal(recurrent_lm.Model().flat.size).astype(np.float32) * np.float32(0.5)
    model, end = recurrent_lm.Model(flat), int(vocabulary.unit[vocabulary.index[recurrent_lm.END]])
    context, h_ = spark.sparkContext, recurrent_lm.HIDDEN
    coded = recurrent_lm._code(numbered, context.broadcast(vocabulary))
    scores = {r.id: r.score for r in recurrent_lm._score(coded, context.broadcast(flat), end).collect()}
    heads, m = vocabulary.heads, {k: getattr(model, k).astype(float) for k in model.names}
    for i in (4, 5, 17, 150, 151):
        h, before, total = np.zeros(h_), end, 0.0
        for word in texts[i]:
            pre, back = m["gates"][before], h @ m["back"]
            z, r = (1 / (1 + np.exp(-(pre[k * h_ : (k + 1) * h_] + back[k * h_ : (k + 1) * h_]))) for k in (0, 1))
            new = np.tanh(pre[2 * h_ :] + r * back[2 * h_ :])
            h = z * h + (1 - z) * new
            of_class = np.exp(h @ m["to_class"] + m["class_bias"])
            of_class /= of_class.sum()
            place = vocabulary.index.get(word.encode(), -1)
            if 0 <= place < heads:
                c, before = place // recurrent_lm.CLASS_WORDS, place
                inside = np.exp(h @ m["to_word"][c] + m["word_bias"][c])
                total += math.log10(of_class[c] * inside[place % recurrent_lm.CLASS_WORDS] / inside.sum())
            else:
                c = recurrent_lm.rare_class(word.encode())
                before = heads + c
                size = vocabulary.rare_tokens[c] + vocabulary.rare_words[c] + 1
                total += math.log10(of_class[recurrent_lm.CLASSES + c] * (counts[word] + 1) / size)
        assert abs(scores[i] - total) < 1e-3 * len(texts[i])


def test_held_out_scores_are_above_the_base(spark):
    found = queries.op1_recurrent_lm(spark, "/root/testdata/sf0.01").filter("held_out")
    row = found.agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert row[0] > row[1] + 0.15


def test_lines_with_one_head_are_no_pairs(spark):
    """Lines that only have a key's length in common are not compared, however many there are; one with few edits still is."""
    rng = random.Random(8)
    lines = ["one head of all is " + "".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(60)]
    lines.append(lines[0][:60] + "Z" + lines[0][60:])
    table = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "id long, line string, n int")
    assert {(r.x, r.y) for r in line_edit_join.candidates(table).collect()} == {(0, 60)}


def test_spread_edits_are_found(spark):
    """As many edits as are allowed, one in every segment, at its ends or all in one place, whatever the slices of pairs are."""
    rng, lines = random.Random(9), []
    for n in [*range(16, 120, 3), *range(120, 900, 41), 5000]:
        k = max(min(n // 16, 2), n // 17)
        own = "".join(rng.choice("abcdefghijklmnop é𝄞") for _ in range(n))
        lines.append(own)
        for places in (range(k), [rng.randrange(k + 1)] * k, sorted(rng.randrange(k + 1) for _ in range(k))):
            line = list(own)
            for i in reversed(list(places)):
                first, last = i * n // (k + 1), (i + 1) * n // (k + 1)
                at = rng.choice((first, last - 1, rng.randrange(first, last)))
                line[at : at + 1] = rng.choice((["Z"], ["Z", line[at]], ["Z", line[at]]))
            lines.append("".join(line))
    table = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "id long, line string, n int")
    found = {(r.x, r.y) for r in line_edit_join.edit_links(table, 1).collect()}
    assert all((i, i + j) in found for i in range(0, len(lines), 4) for j in (1, 2, 3))


def test_near_by_words_and_between(spark):
    rng, rows = random.Random(10), []
    for _ in range(300):
        a = [rng.choice(("", "the", "word", "lines", "of")) for _ in range(rng.randint(1, 12))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(b))
            b[at : at + 1] = rng.choice(([], ["new"], ["new", b[at]], [b[at] + "s"])) or ([] if len(b) > 1 else ["x"])
        rows.append((" ".join(a), " ".join(b), rng.randint(0, 6)))
    pairs = spark.createDataFrame(rows, "a string, b string, k int").select(
        "*", (F.levenshtein("a", "b") <= F.col("k")).alias("near"), line_edit_join.near_by_words("a", "b", "k").alias("words"),
        line_edit_join.near_between("a", "b", "k").alias("between"),
    )
    assert pairs.filter("a != b and between != near").isEmpty() and pairs.filter("words and not near").isEmpty()
    assert pairs.filter("words and a != b").count() > 20 and pairs.filter("between and not words").count() > 20


def test_lines_of_many_pairs_are_found(spark, monkeypatch):
    """With more lines in pairs than are broadcast, their bits choose the texts that are joined; the links stay."""
    rng = random.Random(11)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(40)) for _ in range(60)]
    lines += [x[:20] + "Z" + x[20:] for x in lines]
    table = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "id long, line string, n int")
    monkeypatch.setattr(line_edit_join, "SLICE_CHARS", 1)
    few = {(r.x, r.y) for r in line_edit_join.edit_links(table).collect()}
    monkeypatch.setattr(line_edit_join, "BROADCAST_ROWS", 20)
    monkeypatch.setattr(line_edit_join, "SLOTS", 10)
    assert {(r.x, r.y) for r in line_edit_join.edit_links(table).collect()} == few == {(i, i + 60) for i in range(60)}
