import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from arbora.llm import canonical, copies, packing, tokens, truncation

ENTRY = "entry_id long, worklist_id string, source string, source_value string, scheme string, version string, mapping_kind string, codes string, match_type string, source_field string, _f1 string"


def entry(i, value, source="osm", codes="1|2", kind="EXACT", wl="w"):
    return (i, wl, source, value, "psic", "rev5", kind, codes, None, "category", "clash")


def test_copies(spark):
    rows = [
        entry(5, "a=b; C d"), entry(3, "c D，｜A=B", " [OSM]", " 2 |1"), entry(4, "cd | ab", "osm."), entry(6, "cd", "osm"), entry(7, "CD;;", "osm"), entry(8, "a=b; C d", codes=None), entry(9, "ab,cd", codes=" "), entry(10, None), entry(11, "  "), entry(12, "ab,cd", kind=None, codes=None),
        entry(13, "ab|cd", kind=None, codes=""), entry(14, "--"), entry(15, "!!"), entry(16, "É é"), entry(17, "éé"), entry(18, "x" * 100000), entry(19, "X" * 100000 + " "), (None, *entry(1, "ab")[1:]), entry(20, "a,a,b"), entry(21, "a,b,b"), entry(22, "ab,cd", wl=None), entry(23, "ab,cd", wl=None),
    ]
    got = {(r.keep_id, r.copy_id) for r in copies.entry_copies(spark.createDataFrame(rows, ENTRY)).collect()}
    assert got == {(3, 4), (3, 5), (6, 7), (8, 9), (12, 13), (14, 15), (16, 17), (18, 19), (22, 23)}
    n = {r.entry_id: r.copies for r in copies.entry_records(spark.createDataFrame(rows, ENTRY)).collect()}
    assert n[3] == 3 and n[20] == 1 and sum(n.values()) == len(rows) - 3
    assert copies.entry_copies(spark.createDataFrame([], ENTRY)).count() == 0


def test_copies_that_only_share_a_fingerprint(spark, monkeypatch):
    monkeypatch.setattr(copies, "_sum", lambda pairs, seed: F.lit(1).cast("long"))
    rows = [(i, [f"k={i % 3}", "z"]) for i in range(9)]
    got = {(r.keep_id, r.copy_id) for r in copies.collapse(spark.createDataFrame(rows, "id long, p array<string>"), "id", F.col("p")).collect()}
    assert got == {(i % 3, i) for i in range(3, 9)}


LABELS = [("fsq", "Trade > Parasol Academy", "parasol schoolhouse"), ("fsq", "Health > Battery Stall", "battery booth"), ("fsq", "Trade > Maker's Mirror Brewery", None), ("osm", "shop=sandal_cabin", None), ("overture", "purée_terminal", None)]
CODES = [("psic", "0557", "Rental of household tamarinds"), ("psic", "80", "Storage of frozen lanterns"), ("psic", "8", "Grading of portable pearls")]


@pytest.mark.parametrize("empty", [False, True])
def test_typed_values(spark, empty):
    ref = [(i, "category", s, None, None, n, a) for i, (s, n, a) in enumerate(LABELS, 1)] + [(i, "code", None, s, c, n, None) for i, (s, c, n) in enumerate(CODES, 101)]
    ref = spark.createDataFrame(ref, "ref_id long, kind string, source string, scheme string, code string, label string, alt_label string")
    typed = {
        "parasol acadmey": 1, "PARASOL  ACADEMY": 1, "Parasolacademy": 1, "academy parasol": 1, "p a r a s o l   s c h o o l h o u s e": 1, "parasol schoolhous": 1, "the old parasol academy, 2nd floor (Nanatad)": 1, "párásól ácádémy": 1, "parasol acad": 1, "Btatery stal": 2, "batteries stall": 2, "bttry stll": 2,
        "mirror brewery": 3, "dinosaur academy": -1, "parasol stall": -1, "parasol": -1, "zzz": -1, "sandal cabin": -1, "[Health > Battery Stall]": 2, "x " * 3000 + "battery stall": 2,
    }
    rows = [(i, "fsq", t) for i, t in enumerate(typed)] + [(900, "osm", "sanda1 cabln"), (901, None, "sandal cabin"), (902, "fsq", None), (903, "fsq", " "), (904, "fsq", "Health > Battery Stall"), (905, "fsq", "Health > Battery Stall; Trade > Parasol Academy"), (906, "fsq", "zzz")]
    audit = spark.createDataFrame(rows, "audit_id long, source string, source_value string")
    codes = {"0557": None, "80|8": None, None: None, " ": None, "80.0": 102, "PSIC 80": 102, "05.57": 101, "0557 (rental)": 101, "tamarinds household - rntal": 101, "STORAGE OF FROZEN LATNERNS": 102, "glacier tours": -1, "A": None, "#8": 103}
    entries = spark.createDataFrame([(i, "psic", c) for i, c in enumerate(codes)], "entry_id long, scheme string, codes string")
    if empty:
        assert {r.ref_id for r in canonical.mapped(audit, entries, ref.limit(0)).collect()} == {-1}
        return
    got = defaultdict(list)
    for r in canonical.mapped(audit, entries, ref).collect():
        got[r.table_name, r.row_id].append(r.ref_id)
    want = {("psic_rev5_deterministic_audit", i): [x] for i, x in enumerate(typed.values())} | {("psic_rev5_deterministic_audit", k): [v] for k, v in ((900, 4), (901, -1), (906, -1))}
    want |= {("crosswalk_entries", i): [x] for i, x in enumerate(codes.values()) if x is not None}
    assert dict(got) == want


def test_ids_equal_those_of_the_tokenizer(spark):
    lib = pytest.importorskip("tokenizers")
    t = lib.Tokenizer.from_file(tokens.TOKENIZER)
    t.encode_special_tokens = True
    rnd = random.Random(5)
    texts = ["", None, "aaaa aaaaaaaa", "<|endoftext|>", "it's I'll", " \n\n \t x", "ßẞ 🙏🏽 ﬁ½ 日本語のテキスト。", "\x1c\x85  ", "a" * 3000, "9" * 500, "dup", "dup"]
    texts += ["".join(rnd.choice("ab cd'é日\n19.") for _ in range(rnd.randrange(200))) for _ in range(150)]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, ids string")
    want = {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    assert {r.doc_id: list(r.ids) for r in tokens.encode(df).collect()} == want
    assert {r.doc_id: r.n_tokens for r in tokens.encode(df, count_only=True).collect()} == {i: len(x) for i, x in want.items()}
    assert tokens.encode(df.limit(0)).count() == 0


def test_packing(spark):
    rnd = random.Random(2)
    sizes = [rnd.randrange(1, 60) for _ in range(700)] + [0, None, 100, 101, 200, 255, 100]
    rows = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "id long, n int"), "id", "n", capacity=100, shard=150).collect()
    fill, by_id = defaultdict(int), defaultdict(dict)
    for r in rows:
        fill[r.container] += r.n_tokens
        by_id[r.id][r.piece] = r.n_tokens
    assert max(fill.values()) <= 100
    for i, s in enumerate(sizes):
        assert sum(by_id[i].values()) == (s or 0) and len(by_id[i]) == max(1, -(-(s or 0) // 100))
    assert len([f for f in fill.values() if f]) <= 1.08 * sum(x or 0 for x in sizes) / 100 + 1
    assert packing.pack(spark.createDataFrame([], "id long, n int"), "id", "n").count() == 0


def test_sum_of_squares_against_plain_search():
    def plain(sizes, cap):
        gaps, out = [], []
        cost = lambda gs: sum(gs.count(g) ** 2 for g in set(gs) if g)
        for s in sizes:
            best = min([(cost([*gaps[:b], g - s, *gaps[b + 1 :]]), g - s, 0) for b, g in enumerate(gaps) if g >= s] + [(cost([*gaps, cap - s]), cap - s, 1)])
            out.append(best[0])
            if best[2]:
                gaps.append(cap - s)
            else:
                gaps[next(b for b, g in enumerate(gaps) if g == best[1] + s)] -= s
        return out

    rnd = random.Random(1)
    for _ in range(20):
        sizes, cap = [rnd.randrange(1, 13) for _ in range(40)], 12
        bins, gaps, costs = packing.sum_of_squares(sizes, cap), defaultdict(lambda: cap), []
        for s, b in zip(sizes, bins):
            gaps[b] -= s
            gs = list(gaps.values())
            costs.append(sum(gs.count(g) ** 2 for g in set(gs) if g))
        assert min(gaps.values()) >= 0 and costs[:5] == plain(sizes, cap)[:5]


def test_truncation(spark):
    s = ["The owner says the hall was a mill before.", "Nobody answered the phone at noon, so the entry stays open.", "Is this still an activity?", "Rows came in late and were counted in May.", "See note no. 6 for the hall."]
    rnd = random.Random(4)
    texts = [" ".join(rnd.sample(s, rnd.randrange(2, 6))) for _ in range(150)] + [f"{rnd.choice(s)} Will ask again tomorrow..." for _ in range(10)] + [f"{rnd.choice(s)}\n\nThanks, desk {i}" for i in range(10)]
    whole = len(texts)
    cut = ["The owner says the hall was a mi", f"{s[0]} Nobody answered the", f"{s[1]} See note no.", f"{s[2]} Rows came in late and …", f"{s[3]} Is this still an ac...", '{"note": "The owner', f"{s[0]} {s[1]} [truncated]", f"{s[1]} The owner says (1/2)", f"{s[4]} Nobody answered the phone at n  "]
    texts += cut + [None, "", "  \n", s[0], "Folded pineapples", '{"note": "x"}', "y" * 200000 + ".", s[0] * 3000]
    df = spark.createDataFrame([(i, t, "web" if i % 2 else None, "clash") for i, t in enumerate(texts)], "doc_id long, text string, source string, reason string")
    got = {r.doc_id for r in truncation.truncated(df).collect()}
    assert got == set(range(whole, whole + len(cut)))
    rep = {r.source: (r.n_docs, r.n_cut) for r in truncation.by_source(df, truncation.truncated(df)).collect()}
    assert sum(a for a, _ in rep.values()) == len(texts) and sum(b for _, b in rep.values()) == len(cut)
    assert truncation.truncated(df.limit(0)).count() == 0


def test_copies_of_a_cut_text_do_not_vote_it_out(spark):
    s = ["The owner says the hall was a mill before.", "Nobody answered the phone at noon, so the entry stays open.", "Is this still an activity?", "Rows came in late and were counted in May."]
    rnd = random.Random(6)
    whole = [" ".join(rnd.sample(s, rnd.randrange(2, 5))) for _ in range(60)]
    cut = [f"{s[0]} Nobody answered the", f"{s[3]} Is this still an ac..."]
    for n in (1, 10, 100):
        texts = whole + [f"{c}{' ' * (i % 2)}" for c in cut for i in range(n)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert sorted(r.doc_id for r in truncation.truncated(df).collect()) == list(range(len(whole), len(texts)))


def test_verdicts_are_the_same_at_every_size(spark):
    s = ["The owner says the hall was a mill before.", "Nobody answered the phone at noon, so the entry stays open.", "Is this still an activity?", "Rows came in late and were counted in May."]
    ends = ["", "Will ask again tomorrow...", "Nobody answered the ...", "Is this still an ac..", "Rows came in late and …", "The owner says the ha"]  # from the third on cut
    for n in (1, 15):
        rnd = random.Random(8)
        texts = [(e, f"Desk {''.join(rnd.choices('abcdefghij', k=8))} wrote. {' '.join(rnd.sample(s, 3))} {e}") for e, k in zip(ends, (40, 4, 1, 1, 1, 1)) for _ in range(n * k)]
        df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
        assert {r.doc_id for r in truncation.truncated(df).collect()} == {i for i, (e, _) in enumerate(texts) if e in ends[2:]}


def test_whole_texts_that_others_begin_with(spark):
    rnd = random.Random(9)
    base = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(16, 120))) for _ in range(40)]
    texts = base + [b + "c" * rnd.randrange(1, 40) for b in base[:20]] + base[:5] + ["ab"]
    want = {i for i, t in enumerate(texts) if len(t) >= truncation.GRID[0] and any(u != t and u.startswith(t) for u in texts)}
    got = truncation.prefixes_of_others(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t")
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_copies_of_one_record_at_every_size(spark):
    s = ["The owner says the hall was a mill before.", "Is this still an activity?", "Rows came in late and were counted in May."]
    whole = f"{s[0]} {s[1]} {s[2]}"
    for n in (1, 20):
        rows = [(whole, "a", 1), (f"{s[0]} {s[1]}", "a", 1), (s[0], "a", 1), ("The owner", "a", 1), (s[0], "a", 2), (s[0], "b", 1), (s[0], None, 1), (whole, None, 1), (f"{whole}\n", "a", 1)]
        rows += [(f"{x} {y}", f"l{i}", None) for i in range(n) for x in s for y in s] + [(x, f"m{i}", i) for i in range(n) for x in s]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, label string, written_at long")
        assert {r.doc_id for r in truncation.truncated(df).collect()} == {1, 2, 3}


def test_no_plan_of_truncation_is_large(spark, monkeypatch):
    """All exchanges of a plan are prepared and broadcast by the driver at once; its memory limits them."""
    plans = []

    class Spy(truncation.Stage):
        def __init__(self, df, *args):
            plans.append(df)
            super().__init__(df, *args)

    monkeypatch.setattr(truncation, "Stage", Spy)
    texts = ["The owner says the hall was a mill before.", "The owner says the hall was a mi", "Is this still an activity?"]
    df = spark.createDataFrame([(i, t, "a", i) for i, t in enumerate(texts)], "doc_id long, text string, label string, written_at long")
    found = truncation.truncated(df)
    assert [r.doc_id for r in found.collect()] == [1]
    exchanges = [p._jdf.queryExecution().executedPlan().toString().count("Exchange ") for p in [*plans, found]]
    assert max(exchanges) <= 16, exchanges


def test_phrase_evidence_against_plain_counting(spark):
    rnd = random.Random(12)
    words = ["".join(rnd.choices("ab", k=rnd.randrange(1, 5))) for _ in range(40)] + ["0", "-", "0a"]
    stats = {(rnd.choice("xy"), w): [rnd.randrange(4) for _ in "cefd"] for w in words}
    tails = rnd.sample(sorted(stats), 12) + [("x", sorted(w for a, w in stats if a == "x")[0])] * 2
    want = Counter()
    kind = lambda w: "0" if w[0] == "0" else "p" if w[0] == "-" else "l"
    for (a, w), n in stats.items():
        for b, t in set(tails):
            if a == b and w.startswith(t):
                want.update({(a, t, None, x): v for x, v in (zip("cefd", n) if w == t else [("l", sum(n))])})
        if a in {b for b, _ in tails}:
            want.update({(a, None, kind(w), x): v for x, v in zip("cefd", n)})
    s = spark.createDataFrame([(a, w, *n) for (a, w), n in stats.items()], "a string, w string, c long, e long, f long, d long")
    got = truncation._evidence(s, spark.createDataFrame(tails, "a string, w string"), ["a"]).collect()
    seen = {(r.a, r.w, r.k, x): r[x] for r in got for x in "lcefd" if r[x]}
    # prefixes that no tail asks for may be there as well; no tail meets them
    assert {k: v for k, v in seen.items() if k[1] is None or (k[0], k[1]) in tails} == {k: v for k, v in want.items() if v}
