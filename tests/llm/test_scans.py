"""Secret, licence and language scans against brute force and planted cases."""

import base64
import hashlib
import itertools
import json
import random
import re
import re._parser as sre_parser
import struct
import zlib

import numpy as np
import pytest

from tidemark.llm import language, licenses, secrets
from tidemark.llm.license_rules import RULES_TEXT, parse, prefilter
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def table(spark, name="documents"):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


# -- secrets --------------------------------------------------------------------------------


def base_spans(text):
    flags = re.ASCII | re.IGNORECASE
    kinds = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", flags, lambda m: len(m[2]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", re.ASCII, lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", re.ASCII, lambda m: len(m[0]) >= 16),
    ]
    out = [(m.start(), n, m.end(), k) for n, (k, p, f, ok) in enumerate(kinds) for m in re.finditer(p, text, f) if ok(m)]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def test_secret_query_keeps_every_base_span(spark):
    text_of = dict(table(spark).select("doc_id", "text").collect())
    seen = 0
    for r in QUERIES["op10_secrets"](spark, FOLDER).collect():
        want = base_spans(text_of[r.doc_id] or "")
        seen += len(want)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(r.spans.split(",")) | {""}
    assert seen > 0


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x80 + (size.bit_length() + 7) // 8]) + size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + body


def number(n, size):
    return der(2, bytes([0x11]) * size if n is None else bytes([n]))


PKCS1 = der(0x30, number(0, 1), *[number(None, 40) for _ in range(8)])
SEC1 = der(0x30, number(1, 1), der(4, b"k" * 32))
PKCS8 = der(0x30, number(0, 1), der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(4, SEC1))
CERTIFICATE = der(0x30, der(0x30, der(6, b"\x2a\x86\x48"), der(4, b"x" * 60)), der(3, b"\0" + b"s" * 40))
OPENSSH = secrets.OPENSSH_MAGIC + b"".join(struct.pack(">I", len(x)) + x for x in (b"none", b"none", b"")) + struct.pack(">I", 1) + b"\0\0\0\x08rest-of-it"
HEADER = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=")


def b64(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize(
    "candidate, kind",
    [
        (b64(PKCS1), "der_key"), (b64(SEC1), "der_key"), (b64(PKCS8), "der_key"), (PKCS8.hex(), "der_key"), (b64(OPENSSH), "openssh_key"),
        ("-----BEGIN RSA PRIVATE KEY-----\n" + b64(PKCS1) + "\n-----END RSA PRIVATE KEY-----", "pem_key"),
        ("-----BEGIN PRIVATE KEY-----\\n" + b64(PKCS8) + "\\n-----END PRIVATE KEY-----", "pem_key"),
        (f"{HEADER}.eyJzdWIiOiIxIn0.c2lnbmF0dXJl", "signed_token"),
    ],
)
def test_confirmed_structures(candidate, kind):
    text = f"é here: {candidate} and more"
    assert (kind, 8, 8 + len(candidate)) in secrets.find_spans(text)
    assert candidate not in secrets.redact(text)
    broken = text.replace(candidate[20:44], "A" * 24)
    if kind in ("der_key", "pem_key"):
        assert kind not in {k for k, _, _ in secrets.find_spans(text.replace(candidate, candidate[:-10]))}
    if kind == "signed_token":
        assert kind not in {k for k, _, _ in secrets.find_spans(broken)}


LOCKED = "-----BEGIN RSA PRIVATE KEY-----{0}Proc-Type: 4,ENCRYPTED{0}DEK-Info: AES-128-CBC,{1}{0}{0}{2}{0}-----END RSA PRIVATE KEY-----"


@pytest.mark.parametrize("line_break", ("\n", "\r\n", "\\n"))
def test_encrypted_keys_with_header_lines(line_break):
    body = line_break.join([b64(b"q" * 48), b64(b"w" * 40)])
    candidate = LOCKED.format(line_break, "00112233445566778899AABBCCDDEEFF", body)
    assert ("pem_key", 2, 2 + len(candidate)) in secrets.find_spans(f"é {candidate} .")
    for broken in (candidate.replace("AABB", "AAB"), candidate.replace("4,ENCRYPTED", "5,MIC"), candidate.replace(body, ""), candidate.replace("END RSA", "END EC")):
        assert "pem_key" not in {kind for kind, _, _ in secrets.find_spans(broken)}


@pytest.mark.parametrize("before", ("\\n", "\\r", " ", '"'))
def test_keys_behind_escaped_line_breaks(before):
    key = b64(PKCS8)
    assert ("der_key", len(before), len(before) + len(key)) in secrets.find_spans(before + key)
    assert "der_key" not in {kind for kind, _, _ in secrets.find_spans("n" + key)}


def test_armour_without_an_end_takes_linear_time():
    text = "-----BEGIN PRIVATE KEY-----" + "\n" * 200_000
    assert secrets.find_spans(text * 3) == []


@pytest.mark.parametrize("harmless", [b64(CERTIFICATE), b64(b"just some ordinary text, nothing else at all, really"), "M" * 80, "eyJh.eyJi.x", "MIIB" * 20])
def test_what_does_not_parse_is_not_reported(harmless):
    assert [s for s in secrets.find_spans(f"x {harmless} y") if s[0] in secrets.KINDS[3:]] == []


def test_secret_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "api_key = 'abcdefghijkl'"), (3, "api_key = 'abcdefghijkl'"), (None, "PASSWORD:short"), (5, "a" * 200000 + " token:" + "z" * 12)]
    frame = spark.createDataFrame([(i, t, 9, 4) for i, t in rows], "doc_id long, text string, spans int, n_chars long")
    got = sorted(map(tuple, secrets.digest(secrets.secret_spans(frame)).select("doc_id", "n_assign", "n_hex", "spans").collect()), key=str)
    assert got == sorted([(1, 0, 0, ""), (2, 0, 0, ""), (3, 1, 0, "assign:0:23"), (3, 1, 0, "assign:0:23"), (None, 0, 0, ""), (5, 1, 1, "hex:0:200000,assign:200001:200019")], key=str)
    masked = secrets.redact_documents(frame)
    assert masked.columns == frame.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in masked.where("doc_id in (1, 3)").collect()} == {(1, None, None), (3, "<SECRET>'", 9)}
    assert secrets.secret_spans(frame.limit(0)).count() == 0 == secrets.redact_documents(frame.limit(0)).count()


def test_overlapping_secrets_are_masked_once():
    assert secrets.redact("x token=0123456789abcdef0123 y") == "x <SECRET> y"


# -- licences -------------------------------------------------------------------------------


def plain_licence(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    hits = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_licence_query_keeps_the_base(spark):
    text_of = dict(table(spark).select("doc_id", "text").collect())
    rows = QUERIES["op7_licenses"](spark, FOLDER).collect()
    assert len(rows) == len(text_of)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_licence(text_of[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert any(r.n_base for r in rows)


def plain_detections(text):
    """Every rule tried on every text, and what an earlier match of equal or higher priority contains left out one by one."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered))
    found = []
    for order, label, priority, _, pattern in parse():
        for m in re.finditer(pattern, words):
            start = words[: m.start()].count(" ")
            found.append((start, -(start + m[0].count(" ") + 1), -priority, order, label))
    found.sort()
    kept = [f for i, f in enumerate(found) if not any(g[1] <= f[1] and g[2] <= f[2] for g in found[:i])]
    return [(a, -b, -p, label) for a, b, p, _, label in kept]


def test_licence_query_agrees_with_a_plain_version(spark):
    texts = dict(table(spark).select("doc_id", "text").collect())
    rng = random.Random(3)
    phrases = [t.split("|", 3)[3] for t in RULES_TEXT.strip().splitlines()]
    made = [" ".join(rng.choice([*matched_texts(sre_parser.parse(rng.choice(phrases))), "so", "the", "2 0"]) for _ in range(rng.randrange(12))) for _ in range(150)]
    texts |= {10**6 + i: t for i, t in enumerate(made)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    seen = 0
    for r in licenses.license_spans(frame).collect():
        want = plain_detections(texts[r.doc_id])
        seen += len(want)
        assert [tuple(s) for s in r.spans] == want, texts[r.doc_id]
    assert seen > 300
    for r in QUERIES["op7_licenses"](spark, FOLDER).collect():
        want, base = plain_detections(texts[r.doc_id]), plain_licence(texts[r.doc_id])[4]
        assert r.labels == ",".join(sorted({x[3] for x in want} | set(filter(None, base.split(",")))))
        assert r.score == max((licenses.CONFIDENCE[x[2]] for x in want), default=0.0)


LICENCES = [
    (1, "GNU General-Public  License, version 3.0 or later. MIT\nLicense", "gpl,gpl-3.0,mit"),
    (2, 'Licensed under the Apache License, Version 2.0 (the "License")', "apache,apache-2.0"),
    (3, "CC-BY-SA 4.0 and cc by", "cc-by,cc-by-sa-4.0"),
    (4, "SPDX-License-Identifier: MIT", "mit"),
    (5, "submit licenses", ""),
    (6, "(c) X. All rights reserved.", "proprietary"),
    (7, "under the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    (8, "BSD 3-Clause", "bsd-3-clause"),
    (9, "KKK mit lİcense", ""),
    (10, None, ""),
    (11, "", ""),
    (11, "", ""),
    (None, "released under the MIT license", "mit"),
    (12, "word " * 60000 + "cc by", "cc-by"),
]


def test_licence_rules(spark):
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t, _ in LICENCES], "doc_id long, text string, words int, gates int")
    found = licenses.license_spans(frame)
    got = sorted((str(r.doc_id), r.labels) for r in licenses.digest(found).collect())
    assert got == sorted((str(i), x) for i, _, x in LICENCES)
    for r in licenses.digest(found).join(frame, "doc_id").collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_licence(r.text)
    assert licenses.license_spans(frame.limit(0)).count() == 0


def test_suppression_of_contained_detections(spark):
    text = "released under the mit license then gnu general public license version 2 mit license"
    spans = licenses.license_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert [(s.start, s.end, s.priority, s.label) for s in spans] == [(0, 5, 3, "mit"), (6, 12, 2, "gpl-2.0"), (12, 14, 1, "mit")]
    for a, b in itertools.permutations(spans, 2):
        assert not (b.start <= a.start and a.end <= b.end and b.priority >= a.priority)


def matched_texts(parsed):
    """Every text that a pattern of literals, classes, groups, options and branches matches."""
    out = [""]
    for op, arg in parsed:
        if op is sre_parser.LITERAL:
            options = [chr(arg)]
        elif op is sre_parser.IN:
            options = [chr(c) for kind, x in arg for c in ([x] if kind is sre_parser.LITERAL else range(x[0], x[1] + 1))]
        elif op is sre_parser.MAX_REPEAT:
            options = ["", *matched_texts(arg[2])]
        elif op is sre_parser.SUBPATTERN:
            options = matched_texts(arg[3])
        elif op is sre_parser.BRANCH:
            options = [x for branch in arg[1] for x in matched_texts(branch)]
        else:
            options = [""]
        out = [a + b for a in out for b in options]
    return out


def test_rules_are_many_and_no_gate_shuts_one_out():
    rules = parse()
    assert len(rules) > 200
    gates = re.compile(prefilter(sorted({gate for _, _, _, gate, _ in rules})))
    for _, _, priority, gate, pattern in rules:
        assert priority in licenses.CONFIDENCE
        for text in matched_texts(sre_parser.parse(pattern)):
            assert gate in gates.findall(text), (pattern, text)


# -- language -------------------------------------------------------------------------------


def test_language_query_on_held_out_documents(spark):
    lang_of = dict(table(spark).select("doc_id", "lang").collect())
    rows = QUERIES["op9_language"](spark, FOLDER).collect()
    assert len(rows) == len(lang_of)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang_of[r.doc_id] for r in held) >= 0.97 * len(held)


def plain_label(model, text, penalty):
    """Language and share of letters of one text: each word scored by itself, the best path by trying every step."""
    words = (text or "").split()
    if not words:
        return language.UNKNOWN, 0.0
    scores, letters = zip(*(tuple(x[0] for x in model.word_scores([w])) for w in words))
    names = range(len(model.languages))
    best, came = [float(x) for x in scores[0]], []
    for own in scores[1:]:
        top = max(names, key=lambda a: (best[a], -a))
        steps = [a if best[a] >= best[top] - penalty else top for a in names]
        best = [max(best[a], best[top] - penalty) + float(own[a]) for a in names]
        came.append(steps)
    at = max(names, key=lambda a: (best[a], -a))
    path = [at]
    for steps in reversed(came):
        path.append(at := steps[at])
    held = [sum(int(n) for n, a in zip(letters, reversed(path)) if a == name) for name in names]
    if not sum(held):
        return language.UNKNOWN, 0.0
    most = max(names, key=lambda a: (held[a], -a))
    return model.languages[most], held[most] / sum(held)


def test_language_query_agrees_with_a_plain_version(spark):
    docs = table(spark)
    model = language.fit_on_folds(docs)
    texts = dict(docs.select("doc_id", "text").collect())
    for r in QUERIES["op9_language"](spark, FOLDER).collect():
        if len(texts[r.doc_id] or "") < 6000:
            name, share = plain_label(model, texts[r.doc_id], language.SWITCH_PENALTY)
            assert r.lang_pred == name and r.score == pytest.approx(share, abs=1e-9)


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    from pyspark.sql import functions as F

    docs = table(spark)
    poisoned = docs.withColumn("lang", F.when(language.held_out(docs["doc_id"]), F.lit("xx")).otherwise(docs["lang"]))
    a, b = language.fit_on_folds(docs), language.fit_on_folds(poisoned)
    assert a.languages == b.languages and np.array_equal(a.table, b.table)


def test_the_sample_of_a_hot_language_is_its_lowest_hashes(spark):
    """Many documents of one language, each with a word of its own: the model has seen those of the lowest hashes."""
    from pyspark.sql import functions as F

    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.when(F.col("id") < 2990, "aa").otherwise("bb").alias("lang"))
    lowest = docs.where("lang = 'aa'").orderBy(F.xxhash64("doc_id"), "doc_id").limit(20)
    small = lowest.unionByName(docs.where("lang = 'bb'"))
    a, b = language.fit(docs, "lang", per_language=20), language.fit(small, "lang", per_language=20)
    assert a.languages == b.languages == ["aa", "bb"] and np.array_equal(a.table, b.table)


def test_spans_of_mixed_text(spark):
    docs = table(spark)
    model = language.fit_on_folds(docs)
    text = {x: docs.where(f"lang = '{x}' and length(text) > 600").first().text for x in ("de", "fr")}
    words = {x: t.split()[:60] for x, t in text.items()}
    mixed = " ".join(words["de"] + words["fr"] + words["de"])
    row = language.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert [s.lang for s in row.spans] == ["de", "fr", "de"] and row.lang_pred == "de" and row.score < 0.9
    assert [abs(s.start - w) <= 3 for s, w in zip(row.spans, (0, 60, 120))] == [True] * 3


def test_best_paths_agree_with_brute_force():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 6, 1, 5])
    scores = rng.standard_normal((lengths.sum(), 3)).astype(np.float32)
    path = language.best_paths(scores, lengths, 0.7)
    at = 0
    for n in lengths:
        own = scores[at : at + n].astype(float)
        value = lambda p: sum(own[i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        best = max((value(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
        assert abs(value(path[at : at + n]) - best) < 1e-6
        at += n


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, "это простой русский текст", "ru") for i in range(5)] + [(i, "this is plain english text", "en") for i in range(5, 10)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "lang")
    asked = spark.createDataFrame([(1, "щщщ"), (2, "zzz qqq"), (3, "日本")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.predict(asked, model).collect()}
    assert got[1] == "ru" and got[2] == "en" and got[3] in ("en", "ru")


def test_language_odd_rows(spark):
    model = language.fit_on_folds(table(spark))
    rows = [(1, None), (2, ""), (3, "123 !? 　"), (4, "the and of"), (4, "the and of"), (None, "die und der"), (5, "wort " * 30000)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, lang_pred int, spans int")
    got = language.predict(frame, model).collect()
    assert {r.doc_id: (r.lang_pred, r.score, r.spans) for r in got if r.doc_id in (1, 2, 3)} == {i: ("und", 0.0, []) for i in (1, 2, 3)}
    assert len(got) == 7 and all(r.lang_pred in model.languages for r in got if r.doc_id not in (1, 2, 3))
    kept = language.keep_labelled(frame, model, 0.5)
    assert kept.columns == frame.columns and sorted((str(r.doc_id) for r in kept.collect())) == ["4", "4", "5", "None"]
    assert language.predict(frame.limit(0), model).count() == 0 == language.keep_labelled(frame.limit(0), model, 0.5).count()
    nothing = language.fit(spark.createDataFrame([(1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string"), "lang")
    assert {r.lang_pred for r in language.predict(frame, nothing).collect()} == {"und"}
