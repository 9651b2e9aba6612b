"""Collocations, decontamination and the conversation trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from thornwall.llm import collocations, decontamination, prefix_trie
from thornwall.llm.common import Scratch
from thornwall.session import settings


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


# --- collocations ---


def brute_phrases(docs, min_count, top=2000, cover=50, most=3):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts[lang].update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates, longer, kept = {p: a for p, a in f.items() if " " in p and a >= min_count}, Counter(), []
        for p, a in candidates.items():
            w = p.split(" ")
            for sub in {" ".join(w[i : i + k]) for k in range(2, len(w)) for i in range(len(w) - k + 1)}:
                longer[sub] = max(longer[sub], a)
        for p, a in candidates.items():
            if p not in longer or 100 * longer[p] < cover * a:
                w = p.split(" ")
                parts = [(f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w))]
                score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(parts))
                kept.append((-score, -a, p.encode(), p, left, right))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append({"lang": lang, "rank": rank, "phrase": p, "a": -a, "l": left, "r": right, "n": totals[lang], "score": -score})
    return out


def phrase_table(spark, docs):
    schema = "doc_id long, lang string, text string, H string, words int, phrase string, `a.b` string, f int, n int"
    return spark.createDataFrame([(i, lang, text, "h", 1, "p", "q", 2, 3) for i, (lang, text) in enumerate(docs)], schema)


@pytest.fixture(scope="module")
def phrase_docs():
    dice = random.Random(3)
    vocabulary = ["a", "b", "the", "of", "Über", "ÉTÉ", "x\x0by", " ", "\x1c", "日本", "w" * 300]
    made = [None, "", " \t", ".,;", "one", "the the the the", "A b\tc  d.E f", "of the. of the, of the"]
    made += [" ".join(dice.choices(vocabulary, [9, 5, 30, 20, 3, 2, 1, 1, 1, 2, 1], k=dice.randint(1, 60))) for _ in range(150)]
    made += ["same text again, and again"] * 40 + ["the of " * 3000]
    return [(dice.choice(["en", "de", None, "und", ""]), text) for text in made]


@pytest.mark.parametrize(("budget", "most"), [(1 << 20, 3), (40, 3), (3, 3), (60, 4), (500, 2)])
def test_collocations_match_brute_force(spark, phrase_docs, budget, most):
    """Small budgets make prefixes of two and three words, and many groups."""
    found = rows(collocations.collocations(phrase_table(spark, phrase_docs).repartition(5), min_count=3, max_words=most, budget=budget))
    key = lambda r: (r["lang"], r["rank"])
    assert sorted(found, key=key) == sorted(brute_phrases(phrase_docs, 3, most=most), key=key) and len(found) > 20


def test_collocations_first_of_each_language(spark, phrase_docs):
    found = rows(collocations.collocations(phrase_table(spark, phrase_docs), min_count=3, top=2))
    assert sorted(map(str, found)) == sorted(map(str, brute_phrases(phrase_docs, 3, top=2)))


def test_collocations_of_nothing(spark):
    assert not rows(collocations.collocations(phrase_table(spark, [])))
    assert not rows(collocations.collocations(phrase_table(spark, [(None, None), ("en", " .\n")])))


@pytest.mark.parametrize("most", [1, 7, 30, 1000])
def test_slices_lose_and_repeat_nothing(most):
    """However a text is cut, every suffix starts once, with all its words."""
    dice = random.Random(most)
    text = b"".join(dice.choice([b"a", b"bc", b" ", b"  ", b"\n", b"longerword"]) for _ in range(400))

    def suffixes(parts):
        found = Counter()
        for part, again in parts:
            encoded, piece = collocations._tokens(part)
            words = encoded.to_pylist()
            for i in range(len(words) - again):
                found[tuple(w for w, p in zip(words[i : i + 3], piece[i : i + 3], strict=True) if p == piece[i])] += 1
        return found

    assert suffixes(collocations._slices(text, 3, most)) == suffixes([(text, 0)])


# --- decontamination ---

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_leaks(docs, items, size):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(lowered(text))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows[tuple(words[i : i + size])].add(item)
    out = []
    for doc, text in docs:
        words = WORD.findall(lowered(text))
        hit, held = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    held |= {str(x) for x in found if x is not None}
        out.append({"id": doc, "n_words": len(words), "n_hit": len(hit), "items": sorted(held)})
    return out


def leak_tables(spark, docs, items):
    docs = spark.createDataFrame([(i, t, "x", 1, 2, "d", 3) for i, t in docs], "doc_id long, text string, word string, term int, row int, `a.b` string, Pos int")
    return docs, spark.createDataFrame([(i, t, 5, "w") for i, t in items], "item_id long, text string, phrase long, words string")


@pytest.fixture(scope="module")
def leaks():
    dice = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "İstanbul", "日本", "Σας", "the"]
    sentence = lambda n: " ".join(dice.choices(vocabulary, k=n))
    items = [(i, sentence(dice.randint(3, 30))) for i in range(25)] + [(None, sentence(12)), (30, None), (31, ""), (32, "w1"), (33, "w2 W3"), (34, "the the the the"), (7, sentence(12)), (35, "never seen")]
    items += [(90 + i, items[3][1]) for i in range(5)]
    docs = [(i, sentence(dice.randint(0, 120))) for i in range(60)]
    for i in range(40):
        text = dice.choice(items)[1] or ""
        docs.append((100 + i, f"{sentence(4)} {text.upper() if i % 4 == 0 else text}{dice.choice([' ', '. ', '-x '])}{sentence(5)} {text[: len(text) // 2]}"))
    docs += [(None, items[0][1])] * 3 + [(5, None), (5, ""), (6, "!?"), (6, "the " * 5000), (8, items[4][1]), (8, items[4][1])]
    return docs, items


@pytest.mark.parametrize("size", [1, 2, 5, 10])
def test_contamination_matches_brute_force(spark, leaks, size):
    found = rows(decontamination.contaminated(*leak_tables(spark, *leaks), size=size))
    assert sorted(map(str, found)) == sorted(map(str, brute_leaks(*leaks, size)))


def test_contamination_without_broadcasts(spark, leaks, monkeypatch):
    monkeypatch.setattr(decontamination, "measured", lambda df: df)
    found = rows(decontamination.contaminated(*leak_tables(spark, *leaks), size=5))
    assert sorted(map(str, found)) == sorted(map(str, brute_leaks(*leaks, 5)))


def test_contamination_of_nothing(spark, leaks):
    docs, items = leaks
    assert not rows(decontamination.contaminated(*leak_tables(spark, [], items)))
    for none in ([], [(1, None), (2, " ")]):
        found = rows(decontamination.contaminated(*leak_tables(spark, docs, none)))
        assert len(found) == len(docs) and not any(r["n_hit"] or r["items"] for r in found)


@pytest.mark.parametrize("within", [1, 4, 20])
def test_proximity_matches_brute_force(spark, leaks, within):
    """All terms within a number of words of a place of the rarest one, in any order."""
    docs = [(i, t) for i, (_, t) in enumerate(leaks[0])]
    phrases = [["w1", "w2"], ["w3", "w4", "é"], ["w5"], ["the", "w6", "the"], ["w7", "absent"], ["日本", "w8", "w9", "w10"]]
    scratch = Scratch(spark)
    table = spark.createDataFrame(list(enumerate(phrases)), "phrase long, words array<string>")
    index = decontamination.build(scratch, leak_tables(spark, docs, [])[0], table.select(F.explode("words").alias("word")))
    ids = {r["row"]: r["id"] for r in index.documents.collect()}
    found = {(r["phrase"], ids[r["row"]], r["at"]) for r in decontamination.near(index, decontamination.Phrases(index, table), within).collect()}
    split = {i: WORD.findall(lowered(t)) for i, t in docs}
    counts, expected = Counter(w for words in split.values() for w in words), set()
    term = {r["word"]: r["term"] for r in index.terms.collect()}
    for k, phrase in enumerate(phrases):
        if all(counts[w] for w in phrase):
            rare = min(phrase, key=lambda w: (counts[w], term[w]))
            for i, words in split.items():
                for at, w in enumerate(words):
                    if w == rare and set(phrase) <= set(words[max(0, at - within) : at + within + 1]):
                        expected.add((k, i, at + 1))
    assert found == expected and len(expected) > 10


def test_index_runs_no_python(spark, leaks):
    scratch, seen = Scratch(spark), []
    keep = scratch.keep
    scratch.keep = lambda df: seen.append(df._jdf.queryExecution().toString()) or keep(df)
    docs, items = leak_tables(spark, *leaks)
    table = decontamination.windows(items, 5).select("words").distinct().withColumn("phrase", F.monotonically_increasing_id())
    table = keep(table)
    index = decontamination.build(scratch, docs, table.select(F.explode("words").alias("word")))
    decontamination.exact(index, decontamination.Phrases(index, table))
    assert len(seen) > 5 and not any(re.search("Python|Pandas|Arrow", plan) for plan in seen)


# --- the conversation trie ---


def brute_trie(convs):
    members = defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        saved[node] = sum(saved[c] for c in children[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    for node, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        yield {
            "conv_id": min(own), "depth": len(node), "parent_conv_id": min(members[node[:-1]]) if node else None, "n_convs": len(own), "n_children": len(children[node]),
            "n_leaves": leaves[node], "saved": saved[node], "ends_sha256": hashlib.sha256(ends.encode()).hexdigest(),
        }


def rebuilt(convs):
    out = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(c % 100 if c >= 0 else -(-c % 100)), [])[:h] + convs[c][h:]
    return out


@pytest.fixture(scope="module")
def talks():
    dice = random.Random(11)
    said = [("user", "hi"), ("user", "hi\n"), ("assistant", "yes é"), ("assistant", ""), ("", "x"), ("system", "日本語" * 50)]
    convs = {c: [dice.choice(said) for _ in range(dice.randint(1, 9))] for c in dice.sample(range(0, 900), 260)}
    convs |= {c: [said[0], said[2], said[0]] for c in range(1000, 1080)}
    convs |= {-1: [said[0]], -205: [said[1]] * 3, 1100: [said[0]] * 400, 1199: [said[0]] * 399, 1500: [said[3]] * 2}
    return convs


def talk_table(spark, convs, more=()):
    made = [(c, i if i else None, role or None, text or None, "x", 1, 2) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame([*made, *more], "conv_id long, turn long, role string, text string, path string, nth int, `a.b` int")


def made_trie(spark, table):
    scratch = Scratch(spark)
    return sorted(map(str, rows(prefix_trie.trie(scratch, prefix_trie.with_openings(scratch, prefix_trie.numbered(table))))))


@pytest.mark.parametrize("partitions", [None, 40])
def test_trie_matches_brute_force(spark, talks, partitions):
    """Also with many sorted partitions, so that nodes reach across many borders."""
    more = [(None, 0, "user", "lost", "x", 1, 2)] * 5
    many = {"spark.sql.shuffle.partitions": 40, "spark.sql.adaptive.enabled": "false"} if partitions else {}
    with settings(spark, many):
        found = made_trie(spark, talk_table(spark, talks, more))
    assert found == sorted(map(str, brute_trie(rebuilt(talks)))) and len(found) > 900


def test_trie_of_nothing(spark):
    assert not made_trie(spark, talk_table(spark, {}))
    assert not made_trie(spark, talk_table(spark, {}, [(None, 0, "user", "x", "x", 1, 2)]))
    assert len(made_trie(spark, talk_table(spark, {5: []}, [(105, 1, None, None, "x", 1, 2)]))) == 1 + (zlib.crc32(b"105") % 6 == 0)


def test_repeated_rows_and_ties_are_turns(spark):
    """Five equal rows make five turns; ties go by role, then by the text's digest."""
    tied = [(200, None, "user", "b", "x", 1, 2), (200, None, "a", "z", "x", 1, 2)] + [(200, 1, "user", "t", "x", 1, 2)] * 5
    turns = rows(prefix_trie.numbered(talk_table(spark, {}, tied)))
    assert [r["chars"] for r in sorted(turns, key=lambda r: r["nth"])] == [1] * 7 and len({bytes(r["digest"]) for r in turns}) == 3
    first = min(turns, key=lambda r: r["nth"])
    only = rows(prefix_trie.numbered(talk_table(spark, {}, tied[1:2])))
    assert first["digest"] == only[0]["digest"]


@pytest.mark.parametrize("seed", range(6))
def test_forests_of_any_cut_add_up(seed):
    """However the sorted paths are cut into runs, the shares of each node add up to those of one run."""
    dice = random.Random(seed)
    paths = []
    for conv in range(60):
        path = b""
        for _ in range(dice.randint(0, 6)):
            path += hashlib.blake2b(path[-16:] + bytes([dice.randint(0, 2)]), digest_size=16).digest()
        paths.append((path, conv))
    paths.sort()
    cuts = sorted(dice.sample(range(1, 60), dice.randint(0, 12)))

    def nodes(runs):
        found = defaultdict(lambda: [0, 0, 0, 99])
        for a, b in runs:
            own = paths[a:b]
            before = prefix_trie.shared(paths[a - 1][0], own[0][0]) if a else -1
            after = prefix_trie.shared(own[-1][0], paths[b][0]) if b < len(paths) else -1
            sizes = [[7 + d for d in range(len(p) // 16)] for p, _ in own]
            for row in prefix_trie.Forest([c for _, c in own], [p for p, _ in own], sizes, before, after).rows():
                node = found[row[0], row[1]]
                for k, value in enumerate((row[3], row[4], row[6])):
                    node[k] += value
                node[3] = min(node[3], row[2])
        return dict(found)

    assert nodes(zip([0, *cuts], [*cuts, 60], strict=True)) == nodes([(0, 60)])
