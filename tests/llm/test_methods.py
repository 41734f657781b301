"""The methods against brute force, exact round trips and held-out accuracy."""

import gzip
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.llm import (
    best_fit_packing,
    crf_language,
    divergence,
    license_join,
    merkle,
    superminhash,
    toxicity,
    warc,
)
from almanac.llm.common import mixed
from tests.llm.rows import HAVE_TABLES, SF_DIR

tables = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


# near duplicates


def plain_signature(elements, places=16):
    """SuperMinHash without early stopping, one element after the other."""
    out = [float("inf")] * places
    for e in elements:
        order = list(range(places))
        for j in range(places):
            x = mixed(np.array([e], np.uint64) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
            y = mixed(x ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)
            k = j + int((y[0] * np.uint64(places - j)) >> np.uint64(32))
            order[j], order[k] = order[k], order[j]
            out[order[j]] = min(out[order[j]], float(x[0] >> np.uint64(11)) * 2.0**-53 + j)
    return out


def test_early_stopping_changes_nothing():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 5, 40, 300)]
    owner = np.repeat(np.arange(5), [len(s) for s in sets])
    got = superminhash.signatures(np.concatenate(sets), owner, 5, places=16)
    for row, elements in zip(got, sets):
        assert row.tolist() == plain_signature(elements)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    common, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (400, 50, 50))
    a, b = np.concatenate([common, left]), np.concatenate([common, right])
    got = superminhash.signatures(np.concatenate([a, b]), np.repeat([0, 1], 450), 2)
    assert abs((got[0] == got[1]).mean() - 0.8) < 0.12


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in texts}


def test_groups_of_near_copies_against_brute_force(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = {}
    for i in range(90):  # one large group of near copies, many of them below 0.8 of each other
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
        texts[i] = " ".join(words)
    for i in range(90, 130):  # a drifting chain
        words = texts[i - 1].split()
        words[rng.randrange(len(words))] = f"y{i}"
        texts[i] = " ".join(words)
    for i in range(130, 160):
        texts[i] = " ".join(f"z{rng.randrange(99999)}" for _ in range(rng.randrange(0, 8)))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in superminhash.near_duplicates(df).collect()}
    assert got == brute_components(texts)


def test_blocks_find_every_link_across_components():
    import pandas as pd
    import pyarrow as pa

    from almanac.llm.shingles import shingle_sets

    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(999)}"
        texts.append(" ".join(words))
    texts = sorted({*texts, "short", ""})
    keys = [superminhash.class_key(x) if len(x) else b"none" for x in shingle_sets(pa.array(texts))]
    roots = [keys[0] if i % 3 else k for i, k in enumerate(keys)]
    rows = [(k, r, t, False) for k, r, t in zip(keys, roots, texts)]
    rows += [(k, r, t, True) for k, r, t in zip(keys, roots, texts) if r != keys[0]]
    got = superminhash._across(pd.DataFrame(rows, columns=["cls", "root", "text", "query"]))
    sets = {k: shingles(t) for k, t in zip(keys, texts)}
    linked = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    want = set()
    for k, r in zip(keys, roots):
        for k2, r2 in zip(keys, roots):
            if r != keys[0] and r2 != r and linked(sets[k], sets[k2]):
                want.add((k, r2))
    root_of = dict(zip(keys, roots))
    reached = set()
    for a, b in zip(got["a"], got["b"]):
        assert root_of[a] != root_of[b] and linked(sets[a], sets[b])
        reached |= {(a, root_of[b]), (b, root_of[a])}
    assert want <= reached


def test_components_of_a_long_chain(spark):
    key = lambda i: i.to_bytes(16, "big")
    links = spark.createDataFrame([(bytearray(key(i)), bytearray(key(i + 1))) for i in range(300) if i != 150], "a binary, b binary")
    rows = superminhash.components(links.repartition(7)).collect()
    roots = {int.from_bytes(r["node"], "big"): bytes(r["root"]) for r in rows}
    of = lambda i: roots.get(i, key(i))
    assert len({of(i) for i in range(151)}) == 1 and len({of(i) for i in range(151, 301)}) == 1 and of(0) != of(200)


# packing


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 64, 1024])
    counts = {x: rng.randrange(1, 60) for x in rng.sample(range(1, capacity + 1), min(capacity, 40))}
    rows = best_fit_packing.packing_plan(counts, capacity)
    seen, filled = {}, {}
    for length, first, n, sequence, offset in rows:
        assert first == seen.get(length, 0)
        seen[length] = first + n
        for k in range(n):
            filled.setdefault(sequence + k, []).append((offset, length))
    assert seen == counts
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(x * n for x, n in counts.items())
    assert len(filled) <= 1.25 * -(-total // capacity) + 1


@tables
def test_packed_ids_match_the_tokenizer(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(best_fit_packing.vocabulary_path())
    own.encode_special_tokens = True
    texts = documents(spark)
    odd = {-1: "a  b\n\n c\t d   e   f", -2: "x \n y", -3: "end ", -4: "it's 12,5 %%% <|endoftext|>", -5: " lead", -6: "\x00a \x00 b"}
    df = spark.createDataFrame(list((texts | odd).items()), "doc_id bigint, text string").repartition(3)
    rows = {}
    for r in best_fit_packing.pack_documents(df).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    for i, text in (texts | odd).items():
        pieces = sorted(rows[i], key=lambda r: r["piece"])
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(bytes(r["ids"]) for r in pieces) == ids, i
        assert all(r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["start"] * 4 < len(ids) for r in pieces)
        assert all(r["length"] == 1024 for r in pieces[1:])
    slots = sorted((r["sequence_id"], r["offset"], r["length"]) for p in rows.values() for r in p)
    for a, b in zip(slots, slots[1:]):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)


def test_added_tokens_get_their_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(best_fit_packing.vocabulary_path())
    end = "<|endoftext|>"
    texts = [f"a {end} b", f"{end}{end}\n", f"x  {end}  y\x00", f" it's{end}", "<|endo", "<|ENDOFTEXT|>", f"{end} " * 1100, ""]
    (tmp_path / "sf").mkdir()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows.write.parquet(f"{tmp_path}/sf/documents.parquet")
    got = {}
    for r in best_fit_packing.op8_best_fit_packing(spark, f"{tmp_path}/sf").collect():
        got.setdefault(r["doc_id"], {})[r["start"]] = (r["length"], r["ids_crc32"])
    for i, text in enumerate(texts):
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert sum(n for n, _ in got[i].values()) == len(ids)
        assert all(crc == zlib.crc32(ids[start : start + n].tobytes()) for start, (n, crc) in got[i].items())


# fingerprints


def test_fingerprints_tell_equality_and_locate_edits(spark):
    lines = [f"line {i} of the text with some words" for i in range(60)]
    text = "\n".join(lines)
    edited = "\n".join(lines[:30] + ["line 30 was changed"] + lines[31:])
    longer = "\n".join([*lines[:5], "one more", *lines[5:]])
    df = spark.createDataFrame([(text, edited, longer)], "a string, b string, c string")
    prints = df.select(*[merkle.fingerprint(F.col(c)).alias(c) for c in "abc"])
    row = prints.select(
        "a", "b", merkle.changed(F.col("a"), F.col("b")).alias("ab"), merkle.changed(F.col("c"), F.col("a")).alias("ca"),
        merkle.changed(F.col("a"), F.col("a")).alias("aa"), merkle.likeness(F.col("a"), F.col("c")).alias("near"),
        F.size(F.array_except(merkle.branches(F.col("c"), 1), merkle.branches(F.col("a"), 1))).alias("sections"),
    ).first()
    assert row["a"] != row["b"] and row["ab"] == [30] and row["ca"] == [5] and row["aa"] == []
    assert row["near"] > 0.98 and row["sections"] in (1, 2)


# quality


@tables
def test_base_figures(spark):
    texts = documents(spark)
    for row in divergence.op6_distribution_divergence(spark, SF_DIR).collect():
        text = texts[row["doc_id"]]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        again = {w for w in seen if seen[w] > 1}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row["n_words"] == len(words) and row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        covered = {i + k for i, w in enumerate(windows) if w in again for k in range(3)}
        assert row["n_repeat_words"] == len(covered)


def test_distances_against_plain_python(spark):
    def js(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda x: sum(a * np.log2(a / c) for a, c in zip(x, m) if a)
        return ((kl(p) + kl(q)) / 2) ** 0.5

    counts, reference = [5, 0, 3, 2, 0, 1], [0.5, 0.1, 0.2, 0.1, 0.1, 0.0]
    words, shares = ["the", "of", "the", "zebra", "le", "the"], {"the": 0.2, "of": 0.1, "and": 0.1}
    row = spark.range(1).select(
        divergence.class_distance(F.lit(counts), reference).alias("c"),
        divergence.word_distance(divergence.tally(F.lit(words), ["the", "of", "and", "le"]), F.lit(6), shares).alias("w"),
    ).first()
    total = sum(counts)
    assert row["c"] == pytest.approx(js([c / total for c in counts], reference))
    assert row["w"] == pytest.approx(js([3 / 6, 1 / 6, 0, 2 / 6], [0.2, 0.1, 0.1, 0.6]))


def test_shares_are_of_all_words(spark):
    rare = " ".join(f"wort{i}" for i in range(60))
    text = "the cat " * 3 + " ".join(f"once{i}" for i in range(94))
    df = spark.createDataFrame([(1, text, "en"), (2, rare, "xx"), (3, " \n", "yy")], "doc_id bigint, text string, lang string")
    refs = divergence.references(df, common=0.02)
    assert refs["en"]["words"] == {"the": 0.03, "cat": 0.03} and refs["yy"]["words"] == {}
    # words seen once are common where a language has few of them
    assert divergence.references(df, common=0.004)["xx"]["words"] == pytest.approx({f"wort{i}": 1 / 60 for i in range(60)})
    assert [r["kept"] for r in divergence.judge(df).where("doc_id = 2").collect()] == [True]


@tables
def test_labelled_good_texts_are_kept(spark):
    judged = divergence.op6_distribution_divergence(spark, SF_DIR).where("not base_failed")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = judged.join(labels, "doc_id").where("quality = 1").agg(F.avg(F.col("kept").cast("double"))).first()[0]
    assert good > 0.97


# licenses


def test_similarity_join_against_brute_force():
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(40)]
    templates = {f"l{i}": [" ".join(rng.sample(vocabulary, rng.randrange(1, 15)))] for i in range(12)}
    counts = {v.encode(): rng.randrange(100) for v in vocabulary}
    joined = license_join.Templates(templates, counts, 0.7)
    for _ in range(400):
        block = {v.encode() for v in rng.sample(vocabulary, rng.randrange(1, 36))}
        want = []
        for label, (text,) in sorted(templates.items()):
            own = set(text.encode().split())
            if len(own & block) >= 0.7 * len(own) - 1e-9:
                want.append((label, len(own & block) / len(own)))
        assert joined.matches(block) == want


def test_blocks_of_words_against_brute_force():
    rng = random.Random(12)
    vocabulary = [f"t{i}" for i in range(25)]
    templates = {f"l{i}": [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 14)))] for i in range(10)}
    must, never = {"l1": {"t1", "t2"}, "l4": {"t4"}}, {"l2": {"t3"}, "l5": {"t5", "t6"}}
    counts = {v.encode(): rng.randrange(100) for v in vocabulary}
    joined = license_join.Templates(templates, counts, 0.7, must, never)
    for _ in range(300):
        words = [rng.choice(vocabulary + ["x", "y", "z"] * 6) for _ in range(rng.randrange(1, 70))]
        got = joined.blocks([w.encode() for w in words])
        for label, (text,) in templates.items():
            own, width = set(text.split()), len(text.split()) + len(text.split()) // 4
            blocks = [
                (a, b) for a in range(len(words)) for b in range(a, min(a + width, len(words)))
                if len(own & set(words[a : b + 1])) >= 0.7 * len(own) - 1e-9
                and must.get(label, set()) & own <= set(words[a : b + 1])
                and never.get(label, set()).isdisjoint(words[a : b + 1])
            ]
            mine = [(a, b, share) for a, b, name, share in got if name == label]
            assert {(a, b) for a, b, _ in mine} <= set(blocks)
            for a, b, share in mine:
                assert share == len(own & set(words[a : b + 1])) / len(own)
            if label not in never:  # a block without a foreign token inside may be shorter than the widest one
                assert bool(mine) == bool(blocks)
                most = max((len(own & set(words[a : b + 1])) for a, b in blocks), default=0)
                assert max((share for *_, share in mine), default=0) == most / len(own)


def test_wrapped_and_similar_notices(spark):
    wrap = lambda text, n, mark="": "\n".join(mark + " ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    mit, bsd = license_join.TEMPLATES["mit"][1], license_join.TEMPLATES["bsd"][0]
    texts = [
        (wrap(mit, 10), "mit"), (wrap(mit, 7, " * "), "mit"), (wrap(mit, 1, "# "), "mit"), (wrap(bsd, 5), "bsd"),
        ("Licensed under CC BY 4.0.", "cc-by"), ("Licensed under CC BY-SA 4.0.", "cc-by"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"), ("Released under the BSD License.", ""),
        ("Released under the MIT License.", "mit"), ("This work is licensed under the GNU General Public License, version 2.", "gpl"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-notice"),
        (license_join.TEMPLATES["cc-by-sa"][0], "cc-by-sa"), (license_join.TEMPLATES["cc-by-4"][0], "cc-by-4"),
        ("the work of the author", ""),
    ]
    df = spark.createDataFrame([(i, "Some text before.\n\n" + t + "\nand after it") for i, (t, _) in enumerate(texts)], "doc_id int, text string")
    got = {r["doc_id"]: r["labels"] for r in license_join.scan_licenses(df).collect()}
    assert got == {i: labels for i, (_, labels) in enumerate(texts)}


@tables
def test_phrases(spark):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    texts = documents(spark)
    for row in license_join.op7_license_join(spark, SF_DIR).collect():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row["doc_id"]])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
        ]
        starts = [i for i, _ in places]
        assert row["n_words"] == len(words) and row["n_base"] == len(places)
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))


# languages


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(2)
    scores, moves = rng.normal(size=(7, 3)).astype(np.float32), rng.normal(size=(3, 3))
    chains = np.array([0, 4])
    got = crf_language.forward_backward(scores, chains, moves)[0]
    for first, last in ((0, 4), (4, 7)):
        want = np.zeros((last - first, 3))
        for path in itertools.product(range(3), repeat=last - first):
            total = sum(scores[first + i, p] for i, p in enumerate(path))
            total += sum(moves[a, b] for a, b in zip(path, path[1:]))
            for i, p in enumerate(path):
                want[i, p] += np.exp(total)
        np.testing.assert_allclose(got[first:last], want / want.sum(axis=1, keepdims=True), rtol=1e-5)


@tables
def test_held_out_accuracy_and_switches(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    field = crf_language.train(docs)
    found = crf_language.predict_languages(docs, field).where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.9
    text = {r["lang"]: " ".join(r["text"].split()[:40]) for r in docs.where("lang in ('en', 'de')").orderBy(F.length("text")).collect()}
    both = spark.createDataFrame([(1, f"{text['en']}.\n{text['de']}")], "doc_id bigint, text string")
    runs = crf_language.predict_languages(both, field).first()["runs"]
    assert sum(r["words"] for r in runs if r["lang"] == "en") > 25 and sum(r["words"] for r in runs if r["lang"] == "de") > 25


# toxicity


@tables
def test_restored_words(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = docs.select("text").unionByName(spark.createDataFrame([("worthless idiot pathetic moron trash loser " * 200,)], "text string"))
    reader = toxicity.Restorer(toxicity.language_model(texts))
    for written, meant in (
        ("w0rthless", "worthless"), ("m0r0n", "moron"), ("tr@sh", "trash"), ("paaaathetic", "pathetic"),
        ("l-o-s-e-r", "loser"), ("m o r o n", "moron"), ("IDIOT!!!", "idiot"), ("tra$h###", "trash"), ("plain", "plain"),
    ):
        assert meant in reader.words(f"the {written} is"), written


def test_signs_at_the_ends_and_spaced_words_are_restored(spark):
    plain = "you stupid idiot are such a dumb ass and talk shit all day but we see the wow of it so you idiot go "
    reader = toxicity.Restorer(toxicity.language_model(spark.createDataFrame([(plain * 300,)], "text string")))
    for written, meant in (
        ("$tup1d", "stupid"), ("!d10t", "idiot"), ("!diot", "idiot"), ("|diot", "idiot"), ("@$$", "ass"), ("455", "ass"),
        ("s h ! t", "shit"), ("a s s", "ass"), ("y o u i d i o t", "idiot"), ("y o u i d i o t", "you"), ("sh!+", "shit"),
        ("idiot!", "idiot"), ("wow!!", "wow"), ("(idiot)", "idiot"), ("|stupid|", "stupid"),
    ):
        assert meant in reader.words(f"xx {written} yy"), (written, reader.words(f"xx {written} yy"))
    for number in ("2024", "1,500.00", "12:30", "777", "!!!", "--", "| | |"):
        assert reader.read(number) == (), (number, reader.read(number))


def test_viterbi_is_the_best_of_all_readings():
    rng = np.random.default_rng(8)
    model = rng.uniform(0.5, 5, (toxicity._K,) * 3).astype(np.float32)

    def cost(letters):
        a = b = 0
        total = 0.0
        for letter in letters:
            c = 0 if letter == " " else toxicity._CODE[letter]
            if c or b:
                total += float(model[a, b, c])
                a, b = b, c
        return total + float(model[a, b, 0])

    for token in ("a1b", "0.1", "aaab", "$x4"):
        readings = []
        for choice in itertools.product(*toxicity.options(token)):
            readings.append(sum(p for _, p in choice) + cost([x for x, _ in choice if x]))
        got = toxicity.restore(token, model)
        exact = [
            sum(p for _, p in choice) + cost([x for x, _ in choice if x])
            for choice in itertools.product(*toxicity.options(token))
            if re.sub(" +", " ", "".join(x for x, _ in choice)).lstrip() == got
        ]
        assert min(exact) == pytest.approx(min(readings), abs=1e-4)


@tables
def test_held_out_toxicity(spark):
    scored = toxicity.op2_toxicity(spark, SF_DIR.replace("0.001", "0.01"))
    labels = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    right = sum(r["toxic"] == r["predicted"] for r in rows)
    assert right / len(rows) > 0.9 and sum(r["toxic"] and r["predicted"] for r in rows) >= 0.6 * sum(r["toxic"] for r in rows)


def test_evidence_counts_different_texts(spark):
    rng = random.Random(6)
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % toxicity.HELD_OUT][:210]
    other = lambda n: " ".join(rng.choice("bcdfg") + "".join(rng.choices("aeioulmnrt", k=7)) for _ in range(n))
    common, copied = "the of and in to is it was for on", other(60)
    texts = [f"{common} {other(12)} worthless" for _ in range(90)]  # different toxic texts
    texts += [f"{common} {copied} {other(1)} zebra" for _ in range(30)]  # near copies of one toxic text
    texts += [f"{common} {other(12)} worthless" for _ in range(40)]  # different clean texts
    texts += [f"{common} {copied} {other(1)} worthless yacht" for _ in range(50)]  # near copies of one clean text
    df = spark.createDataFrame(list(zip(learned, texts)), "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(n < 120)) for n, i in enumerate(learned)], "doc_id bigint, toxic int")
    shares = toxicity.train(df, marks)[1]
    assert shares["worthless"] == pytest.approx(90 / (90 + 41 + toxicity.CAUTION))
    assert "zebra" not in shares and "yacht" not in shares


def test_rare_words_do_not_tell_by_chance(spark):
    rng = random.Random(11)
    learned = [i for i in range(2600) if zlib.crc32(str(i).encode()) % toxicity.HELD_OUT][:1800]
    rare = ["".join(rng.choices("bcdfglmnprst", k=8)) for _ in range(6000)]
    # 600 toxic and 1200 clean texts of rare words, each of which is in 15 of them whatever their class
    texts = [" ".join(rng.sample(rare, 50)) + (" worthless" if n % 3 == 0 else "") for n in range(1800)]
    df = spark.createDataFrame(list(zip(learned, texts)), "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(n % 3 == 0)) for n, i in enumerate(learned)], "doc_id bigint, toxic int")
    shares = toxicity.train(df, marks)[1]
    assert shares["worthless"] > 0.9
    assert len([f for f in shares if not "worthless".startswith(f.rstrip("-"))]) <= 3


def test_shares_undo_the_rates_of_the_sample(spark):
    rng = random.Random(12)
    learned = [i for i in range(800) if zlib.crc32(str(i).encode()) % toxicity.HELD_OUT][:600]
    word = lambda: "".join(rng.choices("bcdfglmnprst", k=8))
    # "often" is in all 100 toxic texts and in a third of the 500 clean ones, so it tells nothing by itself
    texts = [" ".join(word() for _ in range(8)) + (" often" if n < 100 or n % 3 == 0 else "") for n in range(600)]
    texts = [t + (" worthless" if n < 100 else "") for n, t in enumerate(texts)]
    df = spark.createDataFrame(list(zip(learned, texts)), "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(n < 100)) for n, i in enumerate(learned)], "doc_id bigint, toxic int")
    shares = toxicity.train(df, marks, {1: 100, 0: 100})[1]
    assert "worthless" in shares and "often" not in shares


# archives


def test_archives_round_trip(spark, tmp_path):
    page = "<p>" + "x" * 1200 + "\r\n\r\nWARC/1.1\r\né</p>"
    rows = [(1, "http://a/ b", page), (2, None, page), (5, "http://c", page), (3, "http://d", "short"), (4, "http://e", "short"),
            (6, "http://f", None), (6, "http://f", None), (None, "http://g", "no id"), (7, "http://h", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/w")
    records = warc.read_warc(spark, f"{tmp_path}/w")
    assert records.count() == 27 and records.where("error is not null").count() == 0
    got = sorted(
        ((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"], r["n_requests"]) for r in warc.page_captures(records).collect())
    )
    n = len(page.encode())
    assert got == [
        (0, 5, "response", None, 1), (1, n, "revisit", 5, 1), (2, n, "revisit", 5, 1), (3, 5, "response", None, 1),
        (4, 5, "response", None, 1), (5, n, "response", None, 1), (6, 0, "response", None, 1), (6, 0, "response", None, 1),
        (7, 0, "response", None, 1),
    ]
    assert warc.assemble(records.limit(0)).count() == 0


def test_foreign_archives():
    one = b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <m>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    packed = gzip.compress(one) + gzip.compress(one)
    assert [r["block"] for r in warc.parse(packed)] == [b"abc", b"abc"]
    broken = list(warc.parse(one + b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort"))
    assert [r["error"] for r in broken] == [None, "bad content length"]
    assert [r["error"] for r in warc.parse(b"nothing")] == ["no record header"]


def test_assembly_through_siblings(spark):
    schema = "record_id string, record_type string, concurrent_to array<string>, error string"
    rows = [("r", "response", ["q2"], None), ("q", "request", ["r"], None), ("q2", "request", [], None), ("m", "metadata", ["q"], None),
            ("x", "metadata", ["gone"], None), ("v", "revisit", [], None), (None, "request", ["r"], None)]
    got = {r["record_id"]: r for r in warc.assemble(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"r", "x", "v"}
    assert {q["record_id"] for q in got["r"]["requests"]} == {"q", "q2"} and got["r"]["metadata"][0]["record_id"] == "m"
    assert got["x"]["main"] is None and got["v"]["requests"] == []


def test_assembled_captures_hold_payloads_and_heads(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<p>é\r\n\r\nx</p>"), (2, "http://b/", "")], "page_id bigint, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/w")
    rows = warc.assemble(warc.read_warc(spark, f"{tmp_path}/w")).collect()
    got = {r["main"]["target_uri"]: r for r in rows}
    assert bytes(got["http://a/"]["main"]["payload"]).decode() == "<p>é\r\n\r\nx</p>" and bytes(got["http://b/"]["main"]["payload"]) == b""
    assert b"Content-Type: text/html" in bytes(got["http://a/"]["main"]["http_head"])
    assert bytes(got["http://a/"]["requests"][0]["http_head"]) == b"GET http://a/ HTTP/1.1\r\n\r\n"
    assert ("warc-type", "response") in [tuple(h) for h in got["http://a/"]["main"]["headers"]]


def test_assembly_through_chains(spark):
    schema = "record_id string, record_type string, concurrent_to array<string>, error string"
    rows = [("r", "response", [], None), ("q", "request", ["r", "m"], None), ("m", "metadata", [], None), ("m2", "metadata", ["m"], None),
            ("c", "conversion", ["m2"], None), ("x", "metadata", ["gone"], None), ("y", "request", ["gone"], None), ("z", "request", [], None),
            ("s", "resource", ["r"], None)]
    got = {r["record_id"]: r for r in warc.assemble(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"r", "s", "x", "z"}
    assert {m["record_id"] for m in got["r"]["metadata"]} == {"m", "m2"} and got["r"]["others"][0]["record_id"] == "c"
    assert got["x"]["main"] is None and [q["record_id"] for q in got["x"]["requests"]] == ["y"]


def test_languages_of_long_texts_and_letters_beyond_the_first_plane(spark):
    rng = random.Random(4)
    german = ["der", "fluss", "läuft", "nicht", "über", "die", "alte", "mühle", "schön", "zwischen", "straße", "und"]
    english = ["the", "river", "runs", "with", "over", "old", "mill", "through", "this", "that", "which", "and"]
    say = lambda words, n: ". ".join(" ".join(rng.choices(words, k=8)) for _ in range(n))
    rows = [(i, say(german, 500), "de") for i in range(40)] + [(i, say(english, 20), "en") for i in range(40, 90)]
    rows.append((1000, "𐐀𐐁𐐂 𐐃𐐄𐐅", None))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert df.where("lang = 'de' and length(text) <= 20000").count() == 0
    got = {r["doc_id"]: r["lang_pred"] for r in crf_language.predict_languages(df).collect()}
    assert all(got[i] == lang for i, _, lang in rows[:-1])
    assert got[1000] in ("de", "en")


def test_damaged_archives_give_error_rows(spark, tmp_path):
    one = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = one.replace(b"<a>", b"<b>").replace(b"abc", b"xyz")
    noise = random.Random(1).randbytes(3000)
    cut = gzip.compress(one) + gzip.compress(two + noise)[:-900]
    rows = list(warc.parse(cut))
    assert [r["block"] for r in rows if not r["error"]] == [b"abc", b"xyz"]
    assert rows[-1]["error"] == "cut-off gzip member"
    hurt = bytearray(gzip.compress(one) + gzip.compress(two))
    hurt[-40:-20] = b"\xff" * 20
    rows = list(warc.parse(bytes(hurt)))
    assert rows[0]["block"] == b"abc" and rows[-1]["error"] == "damaged gzip member"
    # after a bad record the next one is read
    bad = b"WARC/1.1\r\nContent-Length: nine\r\n\r\nshort\r\n\r\n"
    assert [r["error"] for r in warc.parse(one + bad + two)] == [None, "bad content length", None]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "cut.warc.gz").write_bytes(cut)
    (tmp_path / "w" / "good.warc").write_bytes(one + bad + two)
    read = warc.read_warc(spark, f"{tmp_path}/w").collect()
    assert sum(r["error"] is None for r in read) == 4 and sum(r["error"] is not None for r in read) >= 2
    assert {r["record_id"] for r in warc.assemble(warc.read_warc(spark, f"{tmp_path}/w")).collect()} == {"<a>", "<b>"}


def test_captures_with_clashing_columns(spark, tmp_path):
    rows = [(1, "http://a", "x" * 1200, "r", "p"), (2, "http://b", "x" * 1200, "r", "p"), (None, None, None, "r", "p")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, record_type string, Payload string")
    warc.write_warc(pages, f"{tmp_path}/w")
    got = {r["page_id"]: r for r in warc.page_captures(warc.read_warc(spark, f"{tmp_path}/w")).collect()}
    assert got[1]["refers_to"] == 2 and got[2]["record_type"] == "response" and got[None]["payload_bytes"] == 0
