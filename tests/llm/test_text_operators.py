"""Operators over texts against plain versions: small frames with nulls, empty and
long texts, ties, repeated rows, extra columns; and whole small tables."""

import random
from itertools import product

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from netcap.llm import fingerprint, langid, line_dedup, mixing, ngram_join, packing
from netcap.llm.common import read_table

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, root string, _runs int"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows):
    """rows: (doc_id, text); the other columns clash with names used inside."""
    return spark.createDataFrame(
        [(d, t, "en", "s", None, "x", 7) for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(7)
    base = prose(rng, 300, 100_000)
    words = base.split()
    near = [" ".join([*words[:k], f"n{k}", *words[k + 1:]]) for k in (5, 90, 200)]
    chain = [" ".join(words[k:k + 200]) for k in range(0, 100, 20)]
    lines = [prose(rng, 12, 10_000) for _ in range(6)]
    shared = "\n".join(lines[:4])
    return [
        (0, None), (1, ""), (2, "   \n\t "), (3, "One two"), (4, "one  TWO"), (5, "one two three"),
        (6, base), (7, base), (7, base), (8, base.upper()), *((10 + k, t) for k, t in enumerate(near)),
        *((20 + k, t) for k, t in enumerate(chain)), (30, shared), (31, lines[5] + "\n" + shared),
        (32, shared + "\n\n" + lines[4]), (33, "short\n" + lines[1] + "\n" + lines[2] + "\nshort"),
        (40, prose(rng, 40_000, 3000)), (41, "a" * 70_000), (None, base), (None, None),
        (50, "Ärger über Öl x " * 3), (51, lines[3]), (52, lines[3] + " more words"),
    ]


def test_ngram_join_matches_all_pairs(spark, awkward):
    got = ngram_join.ngram_join(frame(spark, awkward)).collect()
    assert sorted(map(str, ((r[0], r[1], r[2]) for r in got))) == sorted(
        map(str, plain.components(awkward)))


def test_ngram_join_on_a_table(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {tuple(r)[:3] for r in ngram_join.ngram_join(docs).collect()}
    assert got == set(plain.components(rows))


@pytest.mark.parametrize("hot", [ngram_join.HOT, 5])
def test_ngram_join_splits_large_groups(spark, monkeypatch, hot):
    """Many sets share most shingles but few link: tiles of several blocks and bands."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rng = random.Random(3)
    base = prose(rng, 160, 100_000).split()
    rows = []
    for k in range(60):
        w = list(base[:rng.randrange(110, 160)])
        for _ in range(rng.randrange(0, 8)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10_000)}"
        rows.append((k, " ".join(w)))
    got = {tuple(r)[:3] for r in ngram_join.ngram_join(frame(spark, rows)).collect()}
    want = set(plain.components(rows))
    assert 2 < len({c for _, _, c in want}) < 60
    assert got == want


@pytest.mark.parametrize("hot", [ngram_join.HOT, 5])
def test_linked_classes_are_all_links(spark, monkeypatch, awkward, hot):
    """Links inside one component too, from pairs made at once and from tiles."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rng = random.Random(4)
    base = prose(rng, 160, 100_000).split()
    rows = [(d, t) for d, t in dict(awkward).items() if d is not None]
    for k in range(40):
        w = list(base[:rng.randrange(120, 160)])
        w[rng.randrange(len(w))] = f"z{k}"
        rows.append((1000 + k, " ".join(w)))
    docs = frame(spark, rows)
    class_of = {r["doc_id"]: r["class_id"] for r in ngram_join.ngram_join(docs).collect()}
    sets = {class_of[d]: plain.shingle_set(t) for d, t in rows if plain.shingle_set(t)}
    want = {(a, b, len(sets[a] & sets[b])) for a in sets for b in sets
            if a < b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in ngram_join.linked_classes(docs).collect()]
    assert len(want) > 2 * 40 and len(got) == len(want) and set(got) == want


def test_one_of_each_keeps_columns_and_one_row(spark, awkward):
    docs = frame(spark, awkward)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    least = {c: None for _, n, c in plain.components(awkward) if n}
    with_words = [r for r in kept.collect() if plain.shingle_set(r["text"])]
    assert sorted(r["doc_id"] for r in with_words) == sorted(least)


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="aB \n\t\x0b\x85 é.", max_size=60))
def test_shingles_split_like_the_pattern(text):
    assert len(ngram_join.shingles(text)) == len(plain.shingle_set(text))


def test_overlap_bound_holds():
    rng = np.random.default_rng(1)
    for n, m, both in ((100, 90, 80), (700, 600, 10), (64, 64, 64), (5, 2000, 4)):
        x = rng.integers(0, 2 ** 63, n + m - both, dtype=np.uint64)
        a, b = np.sort(x[:n]), np.sort(x[n - both:])
        maps = [np.frombuffer(ngram_join.bitmap(s), np.uint64) for s in (a, b)]
        w = min(map(len, maps))
        a_, b_ = (ngram_join.folded(s, w) for s in maps)
        assert ngram_join.overlap_bound(a_, b_, n, m) >= both


def test_line_dedup_matches_plain(spark, awkward):
    docs = frame(spark, awkward)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "_lines", "_deleted"]
    rows = got.collect()
    want = plain.dedup_lines(awkward, line_dedup.MIN_WORDS)
    left = {}
    for d, t in awkward:
        left.setdefault(d, []).append(want[d, t])
    have = {}
    for r in rows:
        have.setdefault(r["doc_id"], []).append(r["text"])
        assert r["_runs"] == 7
    assert {d: sorted(map(str, v)) for d, v in have.items()} == {
        d: sorted(map(str, v)) for d, v in left.items()}
    assert sum(r["_deleted"] for r in rows) > 5


def test_line_runs_grow_both_ways():
    assert line_dedup.merge_runs([(4, 6), (1, 2), (3, 3), (9, 9)]) == [(1, 6), (9, 9)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["", " ", "a b c", "d e f g h", "x", "q\x0bw"]), max_size=9))
def test_windows_match_plain(lines):
    text = "\n".join(lines)
    got = [w[:2] for w in line_dedup.text_windows(text, 5)]
    assert len(got) == len(set(got)) and set(got) == plain.line_windows(text, 5)


def whole_runs_left(rows, min_words):
    """{doc_id: text left} when all lines in any run with an earlier equal go."""
    met, out = set(), {}
    for doc, text in sorted(rows):
        lines = [(k, x.strip()) for k, x in enumerate(text.split("\n")) if x.strip()]
        runs = [lines[a:b] for a in range(len(lines)) for b in range(a + 1, len(lines) + 1)
                if sum(len(x.split()) for _, x in lines[a:b]) >= min_words]
        gone = set()
        for run in runs:  # by first line: an overlapping one before it counts as earlier
            body = tuple(x for _, x in run)
            if body in met:
                gone.update(range(run[0][0], run[-1][0] + 1))
            met.add(body)
        out[doc] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
    return out


def test_line_dedup_deletes_whole_runs(spark):
    rng = random.Random(5)
    a, b, c, d = (prose(rng, n, 100_000) for n in (12, 4, 3, 12))
    rows = [(1, a), (2, "\n".join([a, b, c])), (3, "\n".join(["x y", a, b, c, "z"])),
            (4, "\n".join([b, c, d])), (5, "\n".join(["q", b, c, d, a, b]))]
    short = [prose(rng, n, 100_000) for n in (1, 2, 3, 4, 6, 11)]
    rows += [(10 + k, "\n".join(rng.choice([*short, ""]) for _ in range(rng.randrange(1, 9))))
             for k in range(60)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got == whole_runs_left(rows, line_dedup.MIN_WORDS)
    assert got == {d: t for (d, _), t in plain.dedup_lines(rows, line_dedup.MIN_WORDS).items()}
    assert [got[k] for k in (2, 3, 5)] == [f"{b}\n{c}", "x y\nz", "q"]


def test_copied_runs_leave_nothing_whatever_their_last_lines_hold(spark):
    rng = random.Random(8)
    a, b, c = (prose(rng, n, 100_000) for n in (12, 4, 3))
    run = "\n".join([a, b, c])
    rows = [(1, run), (2, run), (3, run), (4, "\n".join([a, "own words"])),
            (5, "\n".join(["own words", b, c, a]))]
    got = {r["doc_id"]: r["kept_chars"] for r in
           line_dedup.line_dedup_report(frame(spark, rows)).collect()}
    assert got == {1: len(run), 2: 0, 3: 0, 4: 9, 5: len("own words") + 2 + len(b) + len(c)}


def test_line_dedup_moves_only_a_row_s_own_runs(spark, monkeypatch):
    """Rows that share an id, or have none, get the runs of their text, not of all of these rows."""
    rng = random.Random(11)
    head = prose(rng, 15, 100_000)
    rows = [(doc, f"{head}\nown line {k} {n}") for n, doc in enumerate((None, 3)) for k in range(80)]
    rows.append((None, rows[0][1]))
    plain_runs, most = line_dedup.repeated_runs, []

    def watched(*args):
        runs = plain_runs(*args)
        most.append(runs.groupBy("doc_id", "digest").count().agg({"count": "max"}).first()[0])
        return runs

    monkeypatch.setattr(line_dedup, "repeated_runs", watched)
    out = line_dedup.dedup_lines(frame(spark, rows))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "collect_list" not in plan and most == [1]
    got = sorted(r["text"] for r in out.collect())
    firsts = [t for t in got if t.startswith(head)]
    own = [t for _, t in rows]
    assert len(set(firsts)) == 1 and firsts[0] in own
    assert sorted(t.split("\n")[-1] for t in got) == sorted(t.split("\n")[-1] for t in own)


def test_tokenize_matches_the_tokenizer(spark, awkward):
    tok = Tokenizer.from_file(packing.default_tokenizer())
    odd = ["<|endoftext|>", "a<|endoftext|> b  <|endoftext|>", "it's 12½ ²x ٣ Ⅷ _   \r\n",
           "日本語 テキスト 🙂🙂", "   lead", "trail   ", "\n\n\n", "don't WE'LL"]
    rows = [*awkward, *((100 + k, t) for k, t in enumerate(odd))]
    pieces = packing.tokenize(frame(spark, rows)).collect()
    got = sorted((str(p["doc_id"]), p["piece"], p["start"], p["length"], p["ids_crc32"])
                 for p in pieces)
    want = []
    for d, t in rows:
        ids = plain.ids_of(t, tok)
        for k, (s, n) in enumerate(packing.cuts(len(ids), packing.CAPACITY)):
            want.append((str(d), k, s, n, plain.crc(ids[s:s + n])))
    assert got == sorted(want)


def test_long_texts_are_split_at_safe_places(monkeypatch):
    known = packing.text_ids(packing.default_tokenizer())
    text = "one  two\n three\t\tfour   five six " * 40
    whole = known.ids(text)
    for chunk in (1, 2, 7, 50):
        monkeypatch.setattr(packing, "CHUNK", chunk)
        assert known.ids(text) == whole


def test_the_faster_encoder_agrees_on_all_characters():
    """On every character that isn't left to the tokenizer anyway."""
    known = packing.text_ids(packing.default_tokenizer())
    assert known.encode is not None
    differ = []
    for lo in range(0x20, 0x30000, 64):
        codes = [c for c in range(lo, lo + 64) if not 0xD800 <= c < 0xE000
                 and not packing._NEWER.match(chr(c))]
        s = " . ".join(f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)}" for c in codes)
        if known.encode(s) != known.tokenizer.encode(s, add_special_tokens=False).ids:
            differ.append(hex(lo))
    assert not differ


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sSé1½.,! \n\t\xa0\u2003日🙂", max_size=40), st.sampled_from([3, 8, 1 << 20]))
def test_ids_are_the_tokenizers(text, chunk):
    known = packing.text_ids(packing.default_tokenizer())
    saved, packing.CHUNK = packing.CHUNK, chunk
    try:
        ids = known.ids(text)
    finally:
        packing.CHUNK = saved
    assert np.frombuffer(ids, "<u4").tolist() == plain.ids_of(text, known.tokenizer)[:-1]


@pytest.mark.parametrize("text", [" " * 300_000 + "a", "\n" * 5000 + " x" * 50, "a" * 300_000,
                                  "<|endoftext|>" * 3, "x<|endoftext|> y"])
def test_ids_of_extreme_texts(text):
    known = packing.text_ids(packing.default_tokenizer())
    assert np.frombuffer(known.ids(text), "<u4").tolist() == plain.ids_of(text, known.tokenizer)[:-1]


def test_ids_of_a_table_are_the_tokenizers(spark):
    known = packing.text_ids(packing.default_tokenizer())
    for (text,) in read_table(spark, SF_SMALL, "documents").select("text").collect():
        assert np.frombuffer(known.ids(text), "<u4").tolist() == plain.ids_of(
            text, known.tokenizer)[:-1]


def test_pack_fills_without_gaps(spark, awkward):
    pieces = [r.asDict() for r in packing.pack(frame(spark, awkward)).collect()]
    assert len(pieces) == packing.tokenize(frame(spark, awkward)).count()
    plain.check_packing(pieces, packing.CAPACITY)


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_pack_reaches_the_lower_bound(spark, sf_dir):
    pieces = [r.asDict() for r in packing.pack(read_table(spark, sf_dir, "documents")).collect()]
    plain.check_packing(pieces, packing.CAPACITY)
    least = -(-sum(p["length"] for p in pieces) // packing.CAPACITY)
    assert len({p["sequence_id"] for p in pieces}) == least


def test_pack_salts_frequent_lengths(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_SALT", 20)
    rows = [(None if k % 3 else k, "same words") for k in range(400)] + [(5, "x " * k) for k in range(90)]
    pieces = [r.asDict() for r in packing.pack(frame(spark, rows)).collect()]
    assert len(pieces) == len(rows)
    plain.check_packing(pieces, packing.CAPACITY)


HISTOGRAMS = st.dictionaries(st.integers(1, 64), st.integers(1, 60), min_size=1, max_size=30)


@settings(max_examples=50, deadline=None)
@given(HISTOGRAMS)
def test_best_fit_on_counts_is_that_of_single_pieces(histogram):
    rooms = []
    for size in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 64) - size)
    lengths = np.array(sorted(histogram))
    got = packing.best_fit(lengths, np.array([histogram[x] for x in lengths]), 64)
    assert sorted(64 - sum(x * n for x, n in c) for c, times in got for _ in range(times)) == sorted(rooms)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 9), st.tuples(st.integers(1, 3), st.integers(1, 50)),
                       min_size=1, max_size=4))
def test_knapsack_has_the_dearest_filling_of_every_room(items):
    lengths = np.array(sorted(items))
    stock, price = (np.array([items[x][k] for x in lengths]) for k in (0, 1))
    ways = list(product(*(range(n + 1) for n in stock)))
    rooms = np.arange(21)
    lots = packing.knapsack(lengths, stock, price.astype(float), 20)
    for room, filling in zip(rooms, packing.best_fillings(lots, lengths, rooms), strict=True):
        best = max(np.dot(w, price) for w in ways if np.dot(w, lengths) <= room)
        assert all(n <= stock[i] for i, n in filling.items())
        assert sum(int(lengths[i]) * n for i, n in filling.items()) <= room
        assert sum(int(price[i]) * n for i, n in filling.items()) == best


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 2000), max_size=30))
def test_plan_uses_the_histogram_exactly(histogram):
    used = {}
    for config, times in packing.plan(histogram, 64):
        assert times > 0 and sum(x * n for x, n in config) <= 64
        for x, n in config:
            used[x] = used.get(x, 0) + n * times
    assert used == histogram


def test_fingerprints_match_plain(spark, awkward):
    numbered = [(d, t) for d, t in awkward if d is not None]
    rows = sorted(set(numbered), key=lambda r: (-r[0], r[1] or ""))
    want = plain.edited(rows)
    got = {r["doc_id"]: r for r in fingerprint.fingerprint_edits(
        frame(spark, list(set(numbered))), rows_per_range=4).collect()}
    assert len(got) == len(rows)
    sets = [set(fingerprint.digests(t or "").tolist()) for _, t in rows]
    for k, (d, t) in enumerate(rows):
        r, e, nxt = got[d], set(fingerprint.digests(want[k]).tolist()), sets[(k + 1) % len(rows)]
        assert r["edited_sha256"] == plain.sha(want[k]) and r["n_chars"] == len(t or "")
        assert r["near_edited"] == pytest.approx(likeness(sets[k], e))
        assert r["near_next"] == pytest.approx(likeness(sets[k], nxt))
    assert got[6]["fingerprint"] == got[7]["fingerprint"] != got[40]["fingerprint"]


@pytest.mark.parametrize("bounds", [[], [5], [1, 3, 3 + 4, 20], list(range(0, 60, 2))])
def test_ranges_count_the_bounds_reached(spark, bounds):
    values = [-4, 0, 1, 2, 3, 5, 7, 19, 20, 21, 59, 100]
    got = spark.createDataFrame([(v,) for v in values], "v long").select(
        fingerprint._range_of(fingerprint.F.col("v"), bounds)).collect()
    assert [r[0] for r in got] == [sum(b <= v for b in bounds) for v in values]


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)))
def test_peeling_recovers_every_difference(a, b):
    s, t = (np.sort(fingerprint._mix(np.array(sorted(x), np.uint64), 9)) for x in (a, b))
    one, two = fingerprint.sketches([s], 6), fingerprint.sketches([t], 6)
    assert fingerprint.difference([s], [t], one, two).tolist() == [len(a ^ b)]


def test_language_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = (langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
            .filter("held_out").collect())
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_language_of_awkward_texts(spark, awkward):
    got = langid.identify(frame(spark, awkward)).collect()
    assert len(got) == len(awkward)
    for r in got:
        if r["doc_id"] in (0, 1, 2):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    untrained = langid.identify(frame(spark, awkward).withColumn("lang", langid.F.lit(None)))
    assert {r["lang_pred"] for r in untrained.collect()} == {"und"}


def test_trigrams_match_plain():
    texts = ["Aé b", "", "x", "12 ab--cd 3", "ßÄ", "one two"]
    grams, owner, at = langid.trigrams([(t.lower(), False, False) for t in texts])
    got = sorted((int(o), *(int(grams[k]) >> s & 0x1FFFFF for s in (42, 21, 0)))
                 for o, k in zip(owner, at, strict=True))
    want = []
    for o, t in enumerate(texts):
        codes = [0]
        for c in t.lower():
            if c.isalpha():
                codes.append(ord(c))
            elif codes[-1]:
                codes.append(0)
        codes += [0] if codes[-1] else []
        want += [(o, *codes[k:k + 3]) for k in range(len(codes) - 2) if codes[k + 1]]
    assert got == sorted(want)


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    rng = random.Random(3)
    texts = ["", "x", "a" * 50, "--" * 30, *("".join(rng.choice("aäΣb. -") for _ in range(n))
                                             for n in (1, 6, 7, 8, 14, 100, 333))]
    of = np.array([k % 4 for k in range(len(texts))])
    whole = langid.profiles(texts, of, 4, 128)
    for size, batch in ((1, 5), (2, 1), (7, 40), (7, 1000)):
        monkeypatch.setattr(langid, "PART_CHARS", size)
        monkeypatch.setattr(langid, "BATCH_CHARS", batch)
        assert (langid.profiles(texts, of, 4, 128) == whole).all()
    for row in range(4):
        want = sum(plain.trigram_profile(t, 128) for t, k in zip(texts, of, strict=True) if k == row)
        assert (whole[row] == want).all()


def test_language_matches_the_plain_classifier(spark):
    rng = random.Random(11)
    letters = {"aa": "abcdeo", "bb": "abxyzu", "cc": "mnoprä"}
    rows = [(k, lang, " ".join("".join(rng.choice(letters[lang]) for _ in range(4)) for _ in range(12)))
            for k, lang in enumerate(rng.choice(sorted(letters)) for _ in range(60))]
    # Repeated rows, one text in two languages (equal cosines of untrained mixtures), and awkward ones.
    rows += [rows[1]] * 3 + [(70, "aa", "same words"), (71, "bb", "same words"), (72, None, "same words"),
                             (None, "aa", "abc abd"), (73, "cc", None), (74, "bb", "12 -"), (75, "aa", "ж")]
    docs = spark.createDataFrame([(d, t, g, "s", None, "x", 7) for d, g, t in rows], DOCS)
    got = sorted((str(r["doc_id"]), r["held_out"], r["lang_pred"], r["score"])
                 for r in langid.identify(docs).collect())
    want = sorted(plain.languages(rows, langid.DIMENSIONS))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-9)


def test_equal_cosines_take_the_first_name(spark):
    docs = spark.createDataFrame([(d, "equal words", g, "s", None, "x", 7) for d, g in enumerate(
        ["bb", "aa"] * 15)], DOCS)
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} == {"aa"}


def test_mix_rates_and_order(spark, awkward):
    rows = [(k, "t", None, "big" if k % 3 else ("small" if k % 2 else None), 0, "x", 7)
            for k in range(3000)] + [(1, "t", None, "big", 0, "x", 7)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(docs, {"big": 1.0, "small": 49.0}, total=20_000).collect()
    assert sorted(r["place"] for r in out) == list(range(len(out)))
    assert [r["shuffle_key"] for r in sorted(out, key=lambda r: r["place"])] == sorted(
        r["shuffle_key"] for r in out)
    n = {s: sum(r["source"] == s for r in out) for s in ("big", "small")}
    assert abs(n["small"] - 19_600) < 5 * 140 and abs(n["big"] - 400) < 5 * 20
    assert not any(r["source"] is None for r in out)
    again = mixing.mix_documents(docs, {"big": 1.0, "small": 49.0}, total=20_000)
    assert again.columns == docs.columns and again.count() == len(out)


def test_places_over_many_blocks_of_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_SHARD", 50)
    monkeypatch.setattr(mixing, "SHARDS_PER_BLOCK", 3)
    docs = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, null, 'a') AS source")
    out = mixing.mix(docs).orderBy("place").collect()
    assert [r["place"] for r in out] == list(range(len(out))) and len(out) > 4500
    keys = [r["shuffle_key"] for r in out]
    assert keys == sorted(keys)


@pytest.mark.parametrize("name", ["ngram", "lines", "pack", "print", "lang", "mix"])
def test_empty_tables(spark, name):
    empty = frame(spark, [])
    made = {"ngram": ngram_join.ngram_join, "lines": line_dedup.line_dedup_report,
            "pack": packing.pack, "print": fingerprint.fingerprint_edits,
            "lang": langid.identify, "mix": mixing.mix}[name](empty)
    assert made.count() == 0
