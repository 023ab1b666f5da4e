"""Each operator against a plain brute-force version, on given documents and on odd rows."""

import hashlib
import itertools
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cartloom.llm import decontaminate, html_text, licenses, native, ngram_join, packing, personal_data, quality, rtree
from cartloom.llm import secrets, sharding, suffix_dedup, tagger
from cartloom.llm.components import components
from cartloom.llm.queries import QUERIES, tokenizer_path

ODD = [
    (90001, None),
    (90002, ""),
    (90003, " \n\t "),
    (90004, "One"),
    (90005, "one two three four five six\none two three four five six\n"),
    (90006, "one two three four five six\none two three four five six\n"),
    (90007, "ab" * 300),
    (90008, "é" * 150 + " CC BY-NC, the MIT License under the MIT license"),
    (90009, "mail a.b@c-d.example.org ip 10.0.0.256 1.2.3.4 card 4111 1111 1111 1111 +1 (555) 010-9999"),
]


@pytest.fixture(scope="module")
def rows(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in given] + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    # Extra columns whose names clash with the operators' own.
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, n_words int").repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def test_quality_counts(docs, rows, none):
    found = by_id(quality.quality_rules(docs))
    for doc, text in rows:
        words, seen, repeated = spaced(text), defaultdict(list), set()
        for i in range(len(words) - 2):
            seen[tuple(words[i : i + 3])].append(i)
        for at in seen.values():
            if len(at) > 1:
                repeated |= {j for i in at for j in (i, i + 1, i + 2)}
        lines = [x for x in (text or "").split("\n") if spaced(x)]
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed)
        assert tuple(found[doc])[1:7] == expected
        assert not (failed and found[doc]["kept"])
    assert quality.quality_rules(none).count() == 0


def shingles(text):
    words = spaced(lower(text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def brute_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("tile", [ngram_join.TILE, 2])
def test_ngram_join(docs, rows, none, tile):
    found = {r["doc_id"]: tuple(r)[1:] for r in ngram_join.near_duplicates(docs, tile).collect()}
    assert found == brute_components(rows)
    assert ngram_join.near_duplicates(none).count() == 0


def test_tree_search_finds_all():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.5, (200, 32)).astype(np.uint8)
    counts[50:100] = counts[:50]
    sizes = counts.sum(1).astype(np.int64)
    found = {(int(q), int(p)) for a, b, _ in rtree.CountTree(counts, sizes).search(counts, sizes) for q, p in zip(a, b)}
    bound = np.minimum(counts[:, None], counts[None]).sum(2, dtype=np.int64)
    assert found == set(zip(*map(list, np.nonzero(bound >= rtree.needed(sizes[:, None], sizes[None])))))


def test_components_of_a_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (50, 60)], "a long, b long")
    found = {r["id"]: r["component"] for r in components(pairs, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 60: 50}


def test_decontamination(spark, docs, rows, none):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    items += [(9001, "the"), (9002, "of the"), (9003, None), (9004, "one two three four five six"), (None, "the")]
    grams, expected = defaultdict(set), {}
    for item, text in items:
        w = plain_words(text)
        for j in range(len(w) - 9) if len(w) > 9 else range(bool(w)):
            grams[tuple(w[j : j + 10])].add(item)
    for doc, text in rows:
        w, hit, shown = plain_words(text), set(), set()
        for n in {len(g) for g in grams}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in grams:
                    hit |= set(range(j, j + n))
                    shown |= grams[tuple(w[j : j + n])]
        listed = ",".join(sorted(str(i) for i in shown - {None}))
        expected[doc] = (len(w), len(hit), len(shown - {None}), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {r["doc_id"]: tuple(r)[1:] for r in decontaminate.decontaminate(docs, bench).collect()} == expected
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert not decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count()


def brute_repeats(rows):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        cut = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                cut[i : i + 100] = True
            seen.add(raw[i : i + 100])
        kept = np.frombuffer(raw, np.uint8)[~cut].tobytes()
        spans = int((np.diff(np.r_[0, cut.astype(int)]) == 1).sum())
        out[doc] = (len(raw), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup(docs, rows, none, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    assert {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs).collect()} == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_dedup_without_ids(spark):
    shared = "".join(f"{i:03d}" for i in range(50))
    given = [(None, "x" + shared), (None, shared + "and a much longer end " * 9), (1, shared), (1, shared), (None, None), (None, "x" + shared)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(given, "doc_id long, text string")).collect()
    removed = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in found)
    assert [r for r in removed if r[0]] == [(1, 150, 150)] * 2
    unnamed = [r[1:] for r in removed if not r[0]]
    # Of the two unnamed texts one keeps the passage, whichever comes first; a repeated row is judged like its twin.
    size, end = len(given[1][1]), size_of_later_windows(given[1][1][150:])
    assert unnamed in ([(0, 0), (151, 0), (151, 0), (size, 150 + end)], [(0, 0), (151, 150), (151, 150), (size, end)])


def size_of_later_windows(text):
    return brute_repeats([(0, text)])[0][1]


def test_suffix_array_sorts():
    rng = np.random.default_rng(0)
    for n, k in ((1, 2), (2, 1), (60, 1), (300, 2), (1500, 3), (2000, 200)):
        text = rng.integers(1, k + 1, n).astype(np.uint8)
        raw = text.tobytes()
        assert suffix_dedup.suffix_array(text, n + 8).tolist() == sorted(range(n), key=lambda i: raw[i:])


def test_personal_data(docs, rows, none):
    found = by_id(personal_data.personal_data(docs))
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    for doc, text in rows:
        text = text or ""
        digits = lambda m: re.sub("[^0-9]", "", m[0])
        spans = [(m.start(), m.end(), 0) for m in email.finditer(text)]
        spans += [(m.start(), m.end(), 1) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        spans += [(m.start(), m.end(), 2) for m in card.finditer(text) if 14 <= len(digits(m)) <= 19 and personal_data.luhn(digits(m))]
        spans += [(m.start(), m.end(), 3) for m in phone.finditer(text) if 10 <= len(digits(m)) <= 15]
        spans.sort(key=lambda s: (s[0], s[2]))
        got = found[doc]
        assert got["base_sha256"] == hashlib.sha256(personal_data.written_out(spans).encode()).hexdigest()
        assert set(filter(None, personal_data.written_out(spans).split(","))) <= set(got["spans"].split(","))
    assert personal_data.personal_data(none).count() == 0


def test_tagger_on_held_out_texts():
    texts = tagger.labelled_texts(200, 4242)
    hit = wrong = missed = 0
    for (_, spans), got in zip(texts, personal_data.tagged([t for t, _ in texts], tagger.trained())):
        got = {(tagger.KINDS[k], a, b) for a, b, k, _ in got}
        hit, wrong, missed = hit + len(got & set(spans)), wrong + len(got - set(spans)), missed + len(set(spans) - got)
    assert hit / (hit + wrong) > 0.95 and hit / (hit + missed) > 0.95


def test_license_scan(docs, rows, none):
    found = by_id(licenses.license_scan(docs))
    for doc, text in rows:
        words, starts, labels = plain_words(text), [], set()
        for phrase, label in licenses.BASE:
            phrase = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
            starts, labels = starts + here, labels | ({label} if here else set())
        got = found[doc]
        expected = (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert tuple(got)[1:6] == expected
        assert labels <= set(got["labels"].split(","))
    assert licenses.license_scan(none).count() == 0
    assert len(licenses.rules()) > 300


def test_license_notices(spark):
    given = [
        ("MIT License\n\nCopyright (c) 2020 A. B.\n\nPermission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
        ("Permission is hereby granted, free of charge", "mit"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
        ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote", "bsd-3"),
        ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software"
         " Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3"),
        ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1", "lgpl-2.1"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
        ("licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "cc-by-nc-sa"),
        ("It is released under the GPL.", "gpl"),
        ("licensed under the BSD license", "bsd"),
        ("licensed under an Apache license", "apache"),
        ("Photo: A. B., CC BY-SA 4.0", "cc-by-sa"),
        ("CC BY 4.0", "cc-by"),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "gpl-3"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
         " provided that", "isc"),
        ("Licensed under the Apache License, Version 2.0 (the \"License\");", "apache-2"),
        ("GPLv3", "gpl-3"),
        ("This is free and unencumbered software released into the public domain.", "unlicense"),
        ("the committee gave permission to use the hall, and the license plate was public", ""),
    ]
    found = by_id(licenses.license_scan(spark.createDataFrame([(k, x[0]) for k, x in enumerate(given)], "doc_id long, text string")))
    assert {x[0]: found[k]["labels"] for k, x in enumerate(given)} == dict(given)


def test_surviving_detections_against_all_pairs(spark):
    rng = np.random.default_rng(4)

    def beaten(a, b):
        (f, l, _, p, _, _), (g, m, _, q, _, _) = a, b
        if g <= f and m >= l:
            return (m - g) > (l - f) or q < p
        return g < l and f < m and q < p and not (f <= g and l >= m)

    texts = []
    for k in range(60):
        n = int(rng.integers(0, 80))
        first = rng.integers(0, 4 + 4 * k, n)
        last = first + rng.integers(1, 12, n)
        kinds = zip(first.tolist(), last.tolist(), rng.integers(0, 4, n).tolist(), rng.integers(0, 10, n).tolist())
        texts.append((k, [(f, e, f"l{p}", p, 1.0, base == 0) for f, e, p, base in kinds]))
    kind = "k int, every array<struct<first:bigint,last:bigint,label:string,priority:int,score:double,base:boolean>>"
    found = {r["k"]: sorted(map(tuple, r["kept"])) for r in licenses.surviving(spark.createDataFrame(texts, kind)).collect()}
    for k, every in texts:
        assert found[k] == sorted(a for a in every if a[5] or not any(not b[5] and beaten(a, b) for b in every))


def test_license_notices_in_one_long_text(spark):
    n = 3000
    docs = spark.createDataFrame([(1, "licensed under the MIT license, " * n + "all rights reserved")], "doc_id long, text string")
    got = licenses.license_scan(docs).first()
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"]) == (5 * n + 3, n, 1, 5 * n - 4)
    assert (got["base_labels"], got["labels"]) == ("mit", "mit,proprietary")


def test_license_hints():
    for name in [n for _, n, _ in licenses.NAMES]:
        assert all(len(x.strip()) > 1 for x in licenses.literals(name)), name
    assert licenses.literals("(?:simplified|2 clause) bsd|bsd 2 clause") == (" bsd", "bsd 2 clause")
    assert licenses.literals("gnu general public licen[sc]e(?! (?:a|b)c)|gpl ?v?3") == ("gnu general public licen", "gpl")


def test_packing(docs, rows, none):
    found = packing.pack(docs, tokenizer_path()).collect()
    slow, texts = packing.FastTokenizer(tokenizer_path()).slow, dict(rows)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(texts) and sorted(sequences) == list(range(len(sequences)))
    for doc, text in texts.items():
        ids, at = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert zlib.crc32(ids[r["start"] : at].tobytes()) == r["ids_crc32"]
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    total = sum(r["length"] for r in found)
    assert len(sequences) <= total / packing.CAPACITY * 1.01 + 1
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_sharding(docs, rows, none):
    found, texts = sharding.shard(docs).collect(), dict(rows)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in found:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert len(found) == len(texts) and set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(len((t or "").encode()) for t in texts.values())
    assert sharding.shard(none).count() == 0


def test_secret_scan(docs, none, spark):
    more = [(1, 'x token = "' + "0a1b2c3d4e" * 4 + '" y'), (2, "see /usr/local/lib/python/site.py and thathereveringtionable"), (3, None)]
    found = by_id(secrets.secret_scan(spark.createDataFrame(more, "doc_id long, text string")))
    assert found[1]["n_secrets"] == 1 and found[1]["spans"] == "secret:11:51"
    assert found[2]["n_secrets"] == 0 and found[3]["n_candidates"] == 0
    assert secrets.secret_scan(docs).count() == docs.count()


def test_secret_spellings(spark):
    hex_, aws, gh = hashlib.sha1(b"k").hexdigest(), "AKIA" + hashlib.sha1(b"a").hexdigest()[:16].upper(), "ghp_abcdefghijklmnopqrstuvwxyz0123456789"
    b64 = "q7Rt+0ZbW1xK/9vLm3PzY8sD2fGhJ4cN"
    given = [
        (f"--token={gh}", gh),
        (f"run it with ...{aws} now", aws),
        (f"AWS_KEY={aws}", aws),
        (f"DB_URL=x\nAPI_KEY={hex_}\nMODE=fast", hex_),
        (f"https://host.example.net/path/to?api_key={hex_}&page=2", hex_),
        (f"token:{hex_}", hex_),
        (f"secret_key = {b64}==", b64 + "=="),
        (f"aws_secret_access_key={b64}", b64),
        ("password=Xk9#mQ2p", "Xk9#mQ2p"),
        ('{"db_password": "t7!Rz,(q9)Lw"}', "t7!Rz,(q9)Lw"),
        (f"somebody left {gh} in the notes", gh),
        (f"we saw {aws}, then left", aws),
        (f"see keys/{aws}", aws),
    ]
    found = by_id(secrets.secret_scan(spark.createDataFrame([(k, x[0]) for k, x in enumerate(given)], "doc_id long, text string")))
    spans = {text: f"secret:{text.index(value)}:{text.index(value) + len(value)}" for text, value in given}
    assert {text: found[k]["spans"] for k, (text, _) in enumerate(given)} == spans
    runs = [(1, f"x ={hex_}"), (2, f"-{hex_}"), (3, "password: required, author: Shakespeare; token = request.user"), (4, f"commit={hex_}")]
    found = by_id(secrets.secret_scan(spark.createDataFrame(runs, "doc_id long, text string")))
    assert found[1]["n_candidates"] == found[2]["n_candidates"] == 1
    assert found[3]["n_secrets"] == found[4]["n_secrets"] == 0


def test_forest_on_held_out_findings(spark):
    held = secrets.labelled_findings(spark, 9000).subtract(secrets.labelled_findings(spark))
    scored = secrets.trained(spark).transform(secrets._assembled(held))
    assert scored.where("prediction = label").count() > 0.97 * scored.count()


def test_page_text(spark):
    rng = np.random.default_rng(99)
    kept = wanted = extra = 0
    for _ in range(80):
        page, blocks = html_text.made_page(rng)
        got = html_text.main_text(page, html_text.trained()).split("\n\n")
        kept, wanted = kept + len(set(got) & set(blocks)), wanted + len(set(blocks))
        extra += len(set(got) - set(blocks) - {""})
    assert kept > 0.95 * wanted and extra < 0.03 * wanted
    pages = [(1, "u", None), (2, "u", ""), (3, None, "<article><p>A &amp; B<br>c <p>D <!-- x --> e</article><div class='ad'>no</div>"), (4, "u", "<<a <b")]
    found = {r["page_id"]: r for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert found[1]["text"] == found[2]["text"] == "" and found[3]["text"] == "A & B c\n\nD e"
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000, "<a " * 100_000, '<a "' * 100_001 + ">", "<a" * 100_000, "<!" * 100_000, "<li><table>" + "<div>" * 50_000 + "<li></li>" * 50_000],
    ids=["nested", "unclosed", "quotes", "names", "declarations", "items"],
)
def test_page_of_endless_tags(page):
    began = time.process_time()
    html_text.parse(page)
    assert time.process_time() - began < 20


def test_unclosed_tags_are_text():
    def texts(page):
        return [t for t in html_text.parse(page).texts if t]

    assert texts("<p>one <a two</p>") == ["one"]
    assert texts('<p>one <a "two</p>') == ['one <a "two']
    assert texts('<p>a <b c="x>y">d</b></p><p>e <i "f <p>g') == ["a d", 'e <i "f', "g"]
    assert texts("<p>1 < 2 <3</p><a") == ["1 < 2 <3", "<a"]


#: Layouts written and labelled by hand: body, expected blocks.
LAID_OUT = [
    ('<nav><ul><li><a href=/>Home</a></li></ul></nav><div class="top-story"><p>One sentence about the harbour stands here.</p></div>'
     "<footer>&copy; 2020 Paper.</footer>", ["One sentence about the harbour stands here."]),
    ('<div class="content"><p>A short one.</p><p>The sign © is used often.</p></div><div class="footer">&copy; 2021</div>',
     ["A short one.", "The sign © is used often."]),
    ('<article><h1>Title of it</h1><p>Visible text stands here, and more of it follows.</p></article>'
     '<div style="display:none"><p>Not to be seen by anyone at all.</p></div>', ["Title of it", "Visible text stands here, and more of it follows."]),
    ('<main><h1>Title of it</h1><p>Visible text stands here, and more of it follows.</p>'
     '<div class="share">Share this <a href=/x>now</a></div></main>', ["Title of it", "Visible text stands here, and more of it follows."]),
    ("<article><h2>Results</h2><p>The table shows them all.</p><table><tr><th>Team</th><td>Four points</td></tr></table></article>"
     "<aside><h3>Related</h3><ul><li><a href=/q>More</a></li></ul></aside>", ["Results", "The table shows them all.", "Team", "Four points"]),
    ("<header><p>The Daily</p></header><main><p>The bridge was closed today, officials said.</p><figure><img src=a>"
     "<figcaption>The bridge seen from the south bank.</figcaption></figure><dl><dt>Length</dt><dd>It is 300 metres long.</dd></dl></main>",
     ["The bridge was closed today, officials said.", "The bridge seen from the south bank.", "Length", "It is 300 metres long."]),
]


def test_pages_laid_out_by_hand():
    model = html_text.trained()
    for body, blocks in LAID_OUT:
        assert html_text.main_text(f"<html><body>{body}</body></html>", model).split("\n\n") == blocks


def test_page_marginals_against_enumeration():
    rng = np.random.default_rng(8)
    n_features = len(html_text.FEATURES)
    for n in (1, 2, 5, 9):
        model = html_text.Model(rng.normal(size=n_features).tolist(), rng.normal(size=(2, 2, 2)).tolist())
        tree = html_text.Tree()
        for i in range(n):
            parent = -1 if not i else int(rng.choice([k for k in range(i) if tree.texts[k] is None]))
            tree.add(parent, rng.integers(0, n_features, 3).tolist(), "t" if i and rng.random() < 0.4 else None)
        weights = {}
        for states in itertools.product((0, 1), repeat=n):
            own = sum(model.own[k] for y, f in zip(states, tree.features) if y for k in f)
            edges = (model.pair[int(tree.texts[i] is not None)][states[tree.parent[i]]][states[i]] for i in range(1, n))
            weights[states] = np.exp(own + sum(edges))
        total = sum(weights.values())
        node, joint = model.marginals(tree)
        for i in range(n):
            assert node[i] == pytest.approx(sum(w for s, w in weights.items() if s[i]) / total)
            if i:
                pairs = [sum(w for s, w in weights.items() if (s[tree.parent[i]], s[i]) == (a, b)) / total for a in (0, 1) for b in (0, 1)]
                assert joint[i] == pytest.approx(tuple(pairs))


def test_page_text_after_unclosed_raw_tags():
    article = "<article><p>The harbour was quiet that morning, and nobody had seen the boats go out.</p></article>"
    wanted = "The harbour was quiet that morning, and nobody had seen the boats go out."
    above = [
        '<svg class="i"/>',
        '<svg class="i" />',
        '<svg class="i">',
        '<datalist><option value="a"><option value="b"></datalist>',
        '<select><option>One<option selected>Two</select>',
        '<select><optgroup label="x"><option>One</optgroup></select><p>',
        '<option value="a">',
        "<iframe src='x'>",
        "<noscript>",
        "<textarea>",
        "<template>",
    ]
    for start in above:
        for end in ("", "<svg><text>no</text></svg>" if start.endswith("/>") else "", "<select><option>no</option></select>"):
            got = html_text.main_text(f"<html><body>{start}{article}{end}</body></html>", html_text.trained())
            assert wanted in got and "no</" not in got, start
    closed = "<svg><title>no</title></svg><select><option>no</option></select><script>if (a </scripts> b) no</script><textarea>no</textarea>"
    assert html_text.main_text(f"<html><body>{closed}{article}</body></html>", html_text.trained()) == wanted
    texts = html_text.parse("<p>He <del>was</del> <ins>is</ins> <big>really</big> <acronym>BBC</acronym> here</p>").texts
    assert [t for t in texts if t] == ["He was is really BBC here"]


def sentence(seed, n=90):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("bdfgklmnprstvaeiou"), 6)) for _ in range(n))


def test_pipeline_run(spark, tmp_path):
    """`run` against decisions known by construction: rows without ids, with shared ids, repeated, near copies, leaked, short."""
    a, b, c, d, e, leak = map(sentence, range(6))
    near = " ".join(["changed", *c.split()[1:]])
    mail = d + " write to jo.doe@mail.example.org now"
    passage = " ".join(leak.split()[20:40])
    given = [
        (None, a), (None, a), (1, a), (1, a), (2, b), (3, c), (3, b), (9, near), (None, leak), (7, leak + " more"), (7, mail),
        (8, "too short"), (10, None), (None, None), (11, ""), (None, e), (None, e),
    ]
    frame = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    frame.repartition(4).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == frame.columns, name
    expected = {(1, a), (2, b), (3, c), (7, mail.replace("jo.doe@mail.example.org", "[EMAIL]")), (None, e)}
    found = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)

    pieces = corpus_pipeline.run(spark, sf).collect()
    raw = Tokenizer.from_file(tokenizer_path())
    for doc, text in expected:
        ids = np.array([*raw.encode(text, add_special_tokens=False).ids, 0], np.uint32)
        held = sorted((r for r in pieces if r["doc_id"] == doc), key=lambda r: r["start"])
        assert sum(r["length"] for r in held) == len(ids)
        for r in held:
            assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    assert {r["doc_id"] for r in pieces} == {doc for doc, _ in expected}


def test_pipeline_of_nothing(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_sharding_of_repeated_rows(spark, monkeypatch):
    rows = [(1, "t" * 200)] * 800 + [(i, "t" * 150 + str(i)) for i in range(200)] + [(None, "n" * 90)] * 800
    docs = spark.createDataFrame([(*r, "key") for r in rows], "doc_id long, text string, part string").repartition(6)
    for size in (sharding.RANGE_BYTES, 100):
        monkeypatch.setattr(sharding, "RANGE_BYTES", size)
        found = sharding.shard(docs).collect()
        bytes_, slots = defaultdict(int), defaultdict(list)
        for r in found:
            bytes_[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert len(found) == len(rows) and len(bytes_) == 8
        assert max(bytes_.values()) - min(bytes_.values()) <= 2 * 201
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_secrets_in_very_long_texts(spark):
    gh = "ghp_abcdefghijklmnopqrstuvwxyz0123456789"
    texts = ["a" * 10**6, "x1-" * 300000, "." * 10**6, "Ab9/" * 200000 + gh, " ".join(f"token=k{i:07d}QRST" for i in range(2000))]
    found = by_id(secrets.secret_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [found[i]["n_candidates"] for i in range(5)] == [1, 1, 0, 2, 2000]


def test_match_places(spark):
    texts = ["a1 " * n + "z" for n in (0, 1, 255, 256, 257, 700)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, found in df.select("text", native.match_places(F.col("text"), "[a-z]1")).collect():
        assert [(x["at"], x["value"]) for x in found] == [(m.start(), m.group()) for m in re.finditer("[a-z]1", text)]


def test_best_partners_of_equal_points():
    counts = np.random.default_rng(0).poisson(0.5, ngram_join.GROUPS).astype(np.uint8)
    for n in (2, 16, 64, 500):
        frame = pd.DataFrame({"key": [1] * n, "left": 0, "right": 0, "tile": 0, "doc_id": np.arange(n), "component": np.arange(n)})
        frame["n_shingles"], frame["counts"] = int(counts.sum()), [counts.tobytes()] * n
        found = pd.concat(ngram_join.best_partners(iter([frame])))
        assert sorted(found["doc_id"]) == list(range(n)) and set(found["partner"]) == {0, 1}


def test_registered():
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14))
