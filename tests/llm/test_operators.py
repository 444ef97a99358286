import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("evenfall.llm.addresses")

from evenfall.llm import addresses as A  # noqa: E402
from evenfall.llm import boilerplate as B  # noqa: E402
from evenfall.llm import furniture, mixing, neardup, packing, quality, residue, tags, tokens  # noqa: E402


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("284 winterpasture ln., pa", ("284", "winterpasture", "ln", "", "", "pa", "")),
        ("PA 12411, 370 Emeraldcastle Lane", ("370", "emeraldcastle", "ln", "", "", "pa", "12411")),
        ("3693 Brambletower Str W Dunmarrow WI 35411 USA", ("3693", "brambletower", "st", "w", "dunmarrow", "wi", "35411")),
        ("C/ Fuente Dorada 2141 Ste. 28, 73117 Valdeflores", ("2141", "fuente dorada", "calle", "", "valdeflores", "", "73117")),
        ("Vogelhafenstrasse 1874; Altenquell", ("1874", "vogelhafen", "strasse", "", "altenquell", "", "")),
        ("1874 Vogelhafenstraße, Altenquell, HE, 67117", ("1874", "vogelhafen", "strasse", "", "altenquell", "he", "67117")),
        ("1032 Pembleparkway Street; FL 23932", ("1032", "pembleparkway", "st", "", "", "fl", "23932")),
        ("Coorabelle, SA 5301, 1401 Dragonmeadow street Suite 28", ("1401", "dragonmeadow", "st", "", "coorabelle", "sa", "5301")),
        ("Silver Kite Community Hall, 5729 Tuliphaven Str, Sundry Point, Florida 23911-0464", ("5729", "tuliphaven", "st", "", "sundry point", "fl", "23911")),
        ("3018 Marrowterrace Blvd, 2nd floor Lower Saltgrove TX", ("3018", "marrowterrace", "blvd", "", "lower saltgrove", "tx", "")),
        ("Online", None),
        ("Old Yarrow, AZ", None),
        ("", None),
        (None, None),
    ],
)
def test_address_parts(text, expected):
    assert A.parse(text) == expected


def test_addresses(spark):
    seeds = spark.createDataFrame(
        [(1, "3414 Gossamerisland Avenue, East Mirrinor, CA, 63025"), (2, "3414 Gossamerisland Ave.\nEast Mirrinor\nCA 63025"), (3, "3414 Gossamerisland Drive, East Mirrinor, CA"), (4, None), (5, "East Mirrinor, CA"), (6, "1 Sole Street, Nowhere"), (7, "3414 Gossamerisland Avenue, West Mirrinor, CA, 63099")],
        "seed_id long, location_address string",
    )
    events = spark.createDataFrame([(10, "63025 - 3414 Gosamerisland Av, Unit 4", "x"), (11, "Online", "x"), (12, None, "x"), (13, "3414 W Gossamerisland Avenue, East Mirrinor", "x"), (10_000, "63025 - 3414 Gosamerisland Av, Unit 4", "x")], "event_id long, location_address string, seed_id string")
    got = {tuple(r) for r in A.same_addresses(seeds, events).collect()}
    assert {g for g in got if g[1] == "seed"} == {(1, "seed", 2)}
    assert {(1, "event", 10), (2, "event", 10), (1, "event", 10_000), (2, "event", 10_000), (1, "event", 13), (2, "event", 13)} == {g for g in got if g[1] == "event"}
    assert A.same_addresses(seeds.limit(0), events).count() == 0 and A.same_addresses(seeds, events.limit(0)).count() == 1


def test_edits():
    assert A.edits("abcd", "abdc", 2) == 1 and A.edits("abc", "abc", 0) == 0 and A.edits("a", "abcd", 2) == 3


ENTRIES = [(1, "Classic Cars", ["vintage motors"]), (2, "Yoga", None), (3, "Live Jazz", ["big band"]), (4, "Opera & Operetta", []), (5, "Tool Library", ["borrow a tool"])]


@pytest.mark.parametrize(
    ("typed", "tag"),
    [("classic  cars", 1), ("Cars, Classic", 1), ("#ClasicCars", 1), ("vintgae motors", 1), ("Yogas", 2), ("Yogurt", None), ("YOGA (all ages)", 2), ("Genre: big bnad", 3), ("opera and operetta", 4), ("Tolls", None), ("row 3", None), ("★ yoga & more", 2), ("Líve Jazz!", 3), ("x", None), ("!!!", None)],
)
def test_tags(typed, tag):
    assert tags.build(ENTRIES).best(typed) == tag


def test_automaton_as_brute_force():
    r = random.Random(3)
    trie = tags.build(ENTRIES)
    for _ in range(400):
        w = list(r.choice(list(trie.exact)))
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(w))
            w[i : i + 1] = r.choice([[], [w[i], r.choice("aeio")], [r.choice("aeio")], w[i : i + 2][::-1]])
            w = w or ["a"]
        w = "".join(w)
        for k in (1, 2):
            assert sorted((h[0], h[2]) for h in trie.search(w, k)) == sorted((A.edits(w, e, k), m) for e, m in trie.exact.items() if A.edits(w, e, k) <= k)


def test_mapped_tags(spark):
    e = spark.createDataFrame([(1, ["Yoga", "yoga", None, " ", "zzz"], "x"), (2, None, "x"), (3, [], "x")], "event_id long, tag_names array<string>, tag_name string")
    t = spark.createDataFrame([(a, b, c) for a, b, c in ENTRIES], "tag_id int, tag_name string, keywords array<string>")
    assert {tuple(r) for r in tags.mapped_tags(e, t).collect()} == {(1, 1, 2), (1, 4, -1)}
    assert {tuple(r) for r in tags.mapped_tags(e, t.limit(0)).collect()} == {(1, 0, -1), (1, 1, -1), (1, 4, -1)}


PAGE = """<html><head><title>Show</title></head><body><div class="c1"><p>This site uses cookies. Got it!</p></div><nav><a href="#">Home</a> <a href="#">Events</a></nav>
<div class="q"><h1>Show</h1><p>Doors open an hour early so that everyone finds a seat in the hall.</p><p>Cookies are baked in the back room.</p><div><a href="#">Share</a> <a href="#">Print</a></div></div>
<aside><h3>More events</h3><ul><li><a href="/e/1">Other show</a><li><a href="/e/2">Third</a></ul></aside><footer><p>&copy; 2024</p></footer></body></html>"""


def test_boilerplate(spark):
    lines = B.visible_lines(PAGE)
    out = {lines[n - 1] for n in B.boilerplate_lines(PAGE)}
    assert out == {"This site uses cookies. Got it!", "Home Events", "Share Print", "More events", "Other show", "Third", "© 2024"}
    # without a heading, and on a page of many lines
    assert {lines[n - 1] for n in B.boilerplate_lines(PAGE.replace("h1>", "p>").replace("<title>Show</title>", ""))} >= out - {"Got it!"}
    deep = "<div>" * 3000 + "<p>Many words about the evening and the songs in the hall that everybody knows.</p>" * 3000
    assert len(B.boilerplate_lines(deep + "</div>" * 3000 + "<footer><a href='/'>Imprint</a></footer>")) == 1
    assert B.mixed_lines("Home | Events | Log in\nA long evening of songs.\nFollow us @owls") == [1, 3]
    assert B.mixed_lines("Follow us @owls") == [] and B.mixed_lines(None) == [] and B.boilerplate_lines("") == []
    c = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>")], "case_id long, html string")
    e = spark.createDataFrame([(5, "T", "Log in\nA long evening of songs."), (6, "T", None), (7, "T", "")], "event_id long, title string, description string")
    got = {tuple(r) for r in B.boilerplate(c, e).collect()}
    assert ("event", 5, 1) in got and len([g for g in got if g[0] == "case"]) == 7 and len(got) == 8


def test_density_decides(monkeypatch):
    pages = [PAGE.replace("Doors open", f"{k} doors open " + "and songs are sung " * k) for k in range(1, 12)] + [PAGE.replace("h1>", "h2>").replace("<title>Show</title>", "")]
    want = [B.boilerplate_lines(x) for x in pages]
    monkeypatch.setattr(B, "smoothed", lambda lines: [float((7 * k) % 5) for k in range(len(lines))])
    assert sum(a != B.boilerplate_lines(x) for a, x in zip(want, pages)) >= len(pages) / 2


def test_furniture():
    for line in ("We use cookies to show you ads. By going on you agree.", "Log in", "Home > Events > Folk", "Share this event: Facebook Print", "Sign up for our mailing list", "© 2020 All rights reserved", "About | Contact | Search | " * 40):
        assert furniture.reads_like(line)
    assert not furniture.reads_like("A long evening of songs and stories from the sea. " * 30 + "Ask for the newsletter.")
    for body in ("Subscribe to nothing tonight, said the poster, and simply listen.", "Share a table with strangers and swap recipes.", "Copyright and copying are the theme of the 50-minute debate.", "The menu is written on the wall and changes hourly."):
        assert not furniture.reads_like(body)


def residue_sample():
    """(real, residue) fields: titles and descriptions of made-up events, and error messages."""
    r = random.Random(11)
    things = "lanterns quilts maps drums herbs pickles murals kites clocks radios ferries moths otters willows tides cheese".split()
    people = "bakers poets weavers sailors teachers singers children neighbors students printers".split()
    forms = (
        "The {p} of the old harbor show {t} and {u} in the main hall.", "Doors open early so that {p} can look at the {t} in peace.", "A short talk on {t} is followed by songs about {u}.", "Bring {t} to swap with other {p} after the break.",
        "Half of the proceeds help {p} repair the {t}.", "Two {p} met at a market for {t} and have played together ever since.", "Tickets are cheap for {p}, and the {t} are free.",
    )
    say = lambda: r.choice(forms).format(p=r.choice(people), t=r.choice(things), u=r.choice(things))
    real = [(f"{r.choice(things)} and {r.choice(things)} for {r.choice(people)}".capitalize(), True) for _ in range(600)] + [(" ".join(say() for _ in range(r.randint(1, 8))), False) for _ in range(800)]
    # each kind shares some words with the one before it only; the first has trusted wording
    chain = (
        ("Sorry, the page", ("could not be found", "cannot be shown anymore")), ("Hmm, that link", ("cannot be shown anymore", "timed out after 30 seconds")),
        ("Whoops! This listing", ("timed out after 90 seconds", "returned a wrong answer")), ("Yikes, your calendar entry", ("returned a wrong answer", "was moved or deleted")),
    )
    bad = [(f"{a} {b}{c}", False) for a, bs in chain for b in bs for c in (".", "!", *(f" ({r.choice('abcdefgh')}{k})." for k in range(8)))]
    return real, bad


def residue_found(kinds=residue.KINDS, **more):
    real, bad = residue_sample()
    wording = residue.trusted_wording(kinds)
    model = residue.fit([(t, x, 1.0, 1.0 if wording.match(t) else 0.0) for t, x in sorted({*real, *bad})], kinds=kinds, **more)
    score = residue.Scorer(model).score
    return {f for f in bad if score(*f) > 0}, {f for f in real if score(*f) > 0}, set(bad)


def test_residue_is_learnt_by_expectation_maximization():
    with_em, wrong, bad = residue_found()
    without, _, _ = residue_found(rounds=0)
    assert len(with_em) > 0.95 * len(bad) and not wrong
    assert len(without) < 0.9 * len(with_em)


@pytest.mark.parametrize("kind", ["Hmm", "Whoops", "Yikes"])
def test_residue_of_a_kind_that_is_not_trusted(kind):
    found, wrong, bad = residue_found({"page": r"sorry, the page could not be found"})
    mine = {f for f in bad if f[0].startswith(kind)}
    assert len(found & mine) >= 0.8 * len(mine) and not wrong


def test_residue(spark):
    real, bad = residue_sample()
    more = ["{{title}}", "Lorem ipsum dolor sit amet, consectetur.", "Error 404", "Checking your browser before you continue.", "Songs from {{venue}} and stories.", "Access denied. You do not have permission.", "undefined"]
    traps = ["Meet in room 404, next to the [closed] cafeteria, for songs and stories."]
    prose = [t for t, x in real if not x]
    traps = [f"{a} {t} {b}" for t in traps for a, b in zip(prose[:20], prose[20:40])]
    texts = [t for t, _ in real] + traps + [t for t, _ in bad] + more
    rows = [(i, t if i < 600 else None, None if i < 600 else t) for i, t in enumerate(texts)] + [(99_998, None, ""), (99_999, None, None)]
    e = spark.createDataFrame(rows, "event_id long, title string, description string")
    got = {r["event_id"] for r in residue.residue_fields(e).collect()}
    n = len(real) + len(traps)
    assert not got & set(range(n)) and len(got) > 0.95 * (len(texts) - n) and {len(texts) - 7, len(texts) - 3} <= got
    assert residue.residue_fields(e.limit(0)).count() == 0


def test_residue_is_learnt_alike_at_every_size(spark, monkeypatch):
    real, bad = residue_sample()
    r = random.Random(3)
    filler = "dolor sit amet elit magna aliqua veniam nisi tempor labore".split()

    def found(copies):
        """Of the same notices, in a table of so many copies with filler that is never the same."""
        texts = [t for t, x in real if not x] * copies + [t for t, _ in bad] * copies + [f"Lorem ipsum {' '.join(r.sample(filler, 8))}." for _ in range(8 * copies)]
        e = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "event_id long, title string, description string")
        score = residue.Scorer(residue.learn(residue.fields_of(e), kinds={"filler": residue.KINDS["filler"], "page": r"sorry, the page could not be found"})).score
        assert not any(score(t, False) > 0 for t, x in real if not x)
        return sum(score(t, False) > 0 for t, _ in bad)

    for name, value in (("SAMPLE_ROWS", 2_000), ("TRUSTED_FIELDS", 300), ("RATE", 1_000), ("ENOUGH", 30)):
        monkeypatch.setattr(residue, name, value, raising=False)
    small = found(1)
    assert small > 0.9 * len(bad) and found(40) > 0.7 * small


def test_whole_texts_are_scored():
    real, bad = residue_sample()
    fields = [*real, *bad, *((f"Songs by {{{{{x}}}}}.", False) for x in ("artist", "venue", "title", "price", "name"))]
    s = residue.Scorer(residue.fit([(t, x, 1.0, 0.0) for t, x in fields]))
    long = " ".join(t for t, x in real if not x)
    assert s.score(long, False) <= 0 < s.score(long + "\nSongs by {{artist}}.", False)


def test_only_records_that_may_have_a_pair_are_asked_whether_they_count(spark):
    r = random.Random(9)
    rows = [(i, 1_000, " ".join(f"x{r.randrange(5_000)}" for _ in range(20))) for i in range(200)]
    # copies, of which the first doesn't count, and a text that is like them; and copies hours apart
    rows += [(200, 900, "one two three four five"), (201, 1_100, "two one three four five"), (202, 1_000, "five four three two one"), (203, 1_000, "one two three four five six"), (204, 90_000, "seven eight"), (205, 10_000, "eight seven")]
    d = spark.createDataFrame(rows, "id long, at long, text string")
    asked = []

    def counts(t):
        asked.extend(x["id"] for x in t.select("id").collect())
        return t.withColumn("counts", F.when(F.col("id") != 200, F.col("id") > 0))

    got = {tuple(x) for x in neardup.similar_pairs(d, d.select("id", "text"), 0.7, 3600, counts).collect()}
    assert got == {(201, 202), (201, 203), (202, 203)}
    assert sorted(asked) == [200, 201, 202, 203, 204, 205]


def test_filler_does_not_meet(spark, monkeypatch):
    rows = [(1, "Lanterns", "Lorem ipsum dolor sit."), (2, "{{title}} of the harbor", "A talk on maps."), (3, "The harbor", "Quilts that talk about lorem ipsum."), (4, "The harbor", "A talk on maps."), (5, "Lorem ipsum dolor", "Maps."), (6, None, "A talk on maps.")]
    e = spark.createDataFrame([(*x, "2024-05-01T10:00:00Z", None, "s", None) for x in rows], "event_id long, title string, description string, start_datetime string, timezone string, source_id string, crawled_at timestamp")
    sources = spark.createDataFrame([("s", ("UTC",))], "source_id string, context struct<timezone: string>")
    monkeypatch.setattr(residue, "learn", lambda fields: ({"lorem": 4.0, "ipsum": 4.0, "quilts": -9.0, "S:{{a}}": 9.0}, -5.0))
    met, pairs = [], neardup.similar_pairs
    monkeypatch.setattr(neardup, "similar_pairs", lambda records, *more: met.extend(x["id"] for x in records.collect()) or pairs(records, *more))
    assert {tuple(x) for x in neardup.same_events(e, sources, 0.5).collect()} == {(4, 6)}
    assert sorted(met) == [2, 3, 4, 6]


def test_near_duplicates_as_brute_force(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(60):
        base = [r.choice(vocabulary) for _ in range(r.randint(8, 60))]
        for _ in range(r.randint(1, 4)):
            t = list(base)
            for _ in range(r.randint(0, len(t) // 6)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            r.shuffle(t)
            texts.append((" ".join(t), r.choice([0, 1000, 3599, 3600, 7300]) + 10_000))
    texts += [("", 10_000), ("!!!", 10_000)]
    rows = [(i, at, t) for i, (t, at) in enumerate(texts)]
    d = spark.createDataFrame([*rows, (None, 1, "a"), (900, None, "a"), (901, 5, None)], "id long, at long, text string")
    got = {tuple(x) for x in neardup.similar_pairs(d, d.select("id", "text"), 0.7, 3600).collect()}
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and abs(a[1] - b[1]) <= 3600 and neardup.words(a[2]) and neardup.jaccard(neardup.words(a[2]), neardup.words(b[2])) >= 0.7}
    assert got <= want and len(got) >= 0.97 * len(want)
    assert neardup.similar_pairs(d.limit(0), d.limit(0).select("id", "text"), 0.7, 3600).count() == 0


def test_near_duplicates_in_hot_bands(spark, monkeypatch):
    r = random.Random(7)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(150):
        t = list(base)
        for _ in range(r.randint(0, 9)):
            t[r.randrange(60)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(t))
    d = spark.createDataFrame([(i, 10_000 + i % 7, t) for i, t in enumerate(texts)], "id long, at long, text string")
    want = {tuple(x) for x in neardup.similar_pairs(d, d.select("id", "text"), 0.7, 3600).collect()}
    monkeypatch.setattr(neardup, "HOT_SAMPLE", 1)
    monkeypatch.setattr(neardup, "HOT_COUNT", 5)
    got = [tuple(x) for x in neardup.similar_pairs(d, d.select("id", "text"), 0.7, 3600).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 5000


def test_near_duplicates_at_any_date(spark):
    r = random.Random(6)
    year, slot = 31_556_952, neardup.SLOT * 3600
    rows = []
    for start in (-10 * year, 92 * year, 8000 * year, 0):
        border = start // slot * slot
        # just before and behind a slot's border, and one too far off; other words each time, so only these can be pairs
        for gap in (1, 1800, 3600, 3601):
            t = " ".join(f"w{r.randrange(10**9)}" for _ in range(30))
            rows += [(len(rows), border - 1, t), (len(rows) + 1, border - 1 + gap, t + " more"), (len(rows) + 2, border - 1, t + " other")]
    d = spark.createDataFrame(rows, "id long, at long, text string")
    got = {tuple(x) for x in neardup.similar_pairs(d, d.select("id", "text"), 0.7, 3600).collect()}
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and abs(a[1] - b[1]) <= 3600 and neardup.jaccard(neardup.words(a[2]), neardup.words(b[2])) >= 0.7}


def test_likelihood_estimate():
    r = np.random.default_rng(1)
    h = neardup.Hasher()
    for j in (0.3, 0.7, 0.9):
        got = []
        for k in range(60):
            n = 200
            shared = round(2 * n * j / (1 + j))
            a = [f"{k}-{i}" for i in range(n)]
            b = a[:shared] + [f"{k}x{i}" for i in range(n - shared)]
            x = neardup.registers(h.minima([neardup.elements(a), neardup.elements(b)]))
            got.append(neardup.estimate(x[:1], x[1:], np.array([n]), np.array([n]))[0])
        assert abs(np.mean(got) - j) < 0.04
    assert r is not None


def test_packing(spark):
    r = random.Random(2)
    for capacity, sizes in ((100, [r.randint(1, 60) for _ in range(3000)]), (50, [50] * 7 + [26] * 5), (10, [3]), (64, [])):
        c = Counter(sizes)
        plan = packing.solve(dict(c), capacity)
        used = Counter()
        for f, times in plan.fillings:
            assert sum(s * a for s, a in f.items()) <= capacity
            for s, a in f.items():
                used[s] += a * times
        assert used == c
        if sizes and capacity == 100:
            assert plan.bound - 1e-6 <= sum(t for _, t in plan.fillings) <= plan.bound + 1 and plan.bound <= plan.value
            big = packing.solve({s: 100_000 * n for s, n in c.items()}, capacity)
            assert big.rounded > 0.95 * 100_000 * len(sizes) and sum(t for _, t in big.fillings) <= big.bound + 1 and big.value < 1.01 * big.bound
    docs = spark.createDataFrame([(i, " ".join("word" for _ in range(n))) for i, n in enumerate([5, 17, 3, 40, 0, 9, 9, 9])] + [(99, None)], "doc_id long, text string")
    jobs = spark.createDataFrame([("j", 16), ("bad", None)], "job_name string, capacity_tokens int")
    p = packing.packed(docs, jobs).collect()
    assert [tuple(x) for x in packing.faults(docs, jobs).collect()] == [("j", 9, 0, 0, 0, 0, 0)]
    f = packing.fills(docs, jobs).collect()
    assert len(f) == 1 and f[0]["containers"] >= f[0]["least"] and f[0]["documents"] == 9 and f[0]["tokens"] == sum(x["tokens"] for x in p)
    assert packing.packed(docs.limit(0), jobs).count() == 0 and packing.packed(docs, jobs.limit(0)).count() == 0
    assert {x["doc_id"] for x in p} == {*range(8), 99} and all(x["container_tokens"] <= 16 for x in p)
    room = Counter()
    for x in p:
        room[x["container_id"]] += x["tokens"]
    assert all(room[x["container_id"]] == x["container_tokens"] for x in p if x["tokens"])
    assert sum(x["tokens"] for x in p if x["doc_id"] == 3) == 40 and sorted(x["piece"] for x in p if x["doc_id"] == 3) == [0, 1, 2]


def test_mixing(spark):
    r = random.Random(4)
    docs = [(i, r.choice(["a", "a", "a", "b", None]), "word " * r.randint(1, 30)) for i in range(400)] + [(1000, "c", ""), (1001, "c", None)]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string")
    t = spark.createDataFrame([("m", "a", 0.5, 2), ("m", "b", 0.5, 3), ("n", "a", 0.7, 1), ("n", "c", 0.3, 4)], "mix_name string, source string, target_share double, max_repeats int")
    c = mixing.copies(d, t).collect()
    assert all(x["copies"] <= {"a": 2, "b": 3}[x["source"]] for x in c if x["mix_name"] == "m")
    s = {(x["mix_name"], x["source"]): x["actual_share"] for x in mixing.shares(d, t).collect()}
    assert abs(s["m", "a"] - 0.5) < 0.01 and abs(s["m", "b"] - 0.5) < 0.01 and s["n", "c"] == 0 and s["n", "a"] == 1
    assert mixing.copies(d.limit(0), t).count() == 0


def test_token_counts():
    e = tokens.encoder(tokens.VOCABULARY)
    for t in ("", "Hello there, it's 7 o'clock.  Fine\n\n\n", "x" * 50_000, "a" + " " * 19_999 + "b"):
        assert tokens.count_tokens(e, t) == len(e.encode_ordinary(t))
    t = "a" + " \n" * 15_000 + "b c's"
    assert tokens.count_tokens(e, t) == len(e.encode_ordinary(t))
    assert tokens.count_tokens(e, " " * 1_000_000) > 0


def test_running_sum(spark):
    from pyspark.sql import functions as F

    d = spark.range(2000).selectExpr("id", "id % 3 AS g", "id % 7 AS v")
    got = tokens.running_sum(d, ["g"], F.xxhash64("id"), ["id"], F.col("v"), 10 * tokens.GROUP_ROWS).collect()
    for g in range(3):
        mine = sorted((x["before"], x["v"]) for x in got if x["g"] == g)
        assert mine[0][0] == 0 and max(b + v for b, v in mine) == sum(v for _, v in mine)
        assert sum(b for b, _ in mine) == sum(np.cumsum([0, *[x["v"] for x in sorted((y for y in got if y["g"] == g), key=lambda y: (y["before"], y["v"] != 0))]])[:-1])


COMMON = frozenset("the a of and in to is was for with that on at by from an every who are it this his her".split())


@pytest.mark.parametrize(
    ("text", "prose"),
    [
        ("The hall is open to everyone who likes songs. Doors open an hour early for families with small children.", True),
        ("the hall is open to everyone who likes songs\ndoors open an hour early for families with small children", True),
        ("- The hall is open to everyone who likes songs.\n- Doors open an hour early for families.", True),
        ("Jazz Night\n\nThe hall is open to everyone who\nlikes songs and stories of the sea. 🎶", True),
        ("Monday: closed.\nTuesday: closed.\nWednesday: 10-18.", False),
        ("a,b,c\n1,2,3\n4,5,6", False),
        ("T h e  h a l l  i s  o p e n  t o  e v e r y o n e .", False),
        ("buy cheap tickets online cheap tickets buy best price cheap", False),
        ("function(){var a=85;for(var i=0;i<a.length;i++){e[i]=t(n[i])}};", False),
        ("Ann Bell\nBob Carr\nCid Dole\nDot Ellis", False),
        ("", False),
        ("!!! ### ???", False),
    ],
)
def test_prose(text, prose):
    s = dict(zip(quality.NAMES, quality.statistics(text, COMMON)))
    assert (s["sentence_ratio"] >= 0.7) == prose


def quality_sample(spark):
    r = random.Random(8)
    say = lambda: f"The {r.choice(['hall', 'yard', 'attic'])} is open to {r.choice(['everyone', 'children', 'bakers'])} who {r.choice(['likes', 'like'])} songs and stories of the {r.choice(['sea', 'hill'])}."
    name = lambda: r.choice("Ann Bob Cid Dot Eve Fay Gus Hal".split()) + " " + r.choice("Bell Carr Dole Ellis Ford Gray".split())
    prose = [(i, " ".join(say() for _ in range(r.randint(2, 9))), r.choice(["en", "de", None])) for i in range(300)]
    lists = [(1000 + i, "\n".join(f"{name()}; {r.randint(1, 99)}" for _ in range(r.randint(3, 9))), r.choice(["en", "de", None])) for i in range(90)]
    copies = [(2000 + i, "Ann Bell | 3\nBob Carr | 4\nCid Dole | 9", "fr") for i in range(200)]
    some = [(3000 + i, say() + " " + say(), "fr") for i in range(20)]
    nothing = [(4000, "", "en"), (4001, None, None), (4002, "!!! ###", "EN-xx")]
    w = spark.createDataFrame([("en", x) for x in COMMON], "lang string, word string")
    return spark.createDataFrame(prose + lists + copies + some + nothing, "doc_id long, text string, lang string"), w, {x[0] for x in lists + copies + nothing}


def test_not_prose(spark):
    d, w, junk = quality_sample(spark)
    got = {x["doc_id"] for x in quality.not_prose(d, w).collect()}
    # copies of one list are most of a language, and don't hide
    assert len(got & junk) > 0.97 * len(junk) and len(got - junk) < 6
    assert quality.not_prose(d.limit(0), w).count() == 0
    assert {x["doc_id"] for x in quality.not_prose(d.where("doc_id < 300 OR doc_id = 4001"), w).collect()} == {4001}


def test_tails_decide(spark, monkeypatch):
    from pyspark.sql import functions as F

    d, w, _ = quality_sample(spark)
    want = {x["doc_id"] for x in quality.not_prose(d, w).collect()}
    real = quality.tails
    # the same tails, dealt to other documents
    shuffled = lambda stats: real(stats).withColumn("doc_id", (F.col("doc_id") * 7919 + 13) % 4003)
    monkeypatch.setattr(quality, "tails", shuffled)
    assert len({x["doc_id"] for x in quality.not_prose(d, w).collect()} & want) < 0.6 * len(want)


def test_exact_tails(spark):
    r = random.Random(9)
    rows = [(r.choice("ab"), "s", r.choice([0.5, 1.0, r.random(), float("-inf")])) for _ in range(500)]
    got = {(x["language"], x["value"]): x["tail"] for x in quality.exact_tails(spark.createDataFrame(rows, "language string, statistic string, value double")).collect()}
    for g in "ab":
        mine = [v for a, _, v in rows if a == g]
        assert all(abs(got[g, v] - sum(x <= v for x in mine) / len(mine)) < 1e-12 for v in mine)


def test_parting():
    r = np.random.default_rng(2)
    two = Counter(np.concatenate([r.normal(100, 20, 4000), r.normal(300, 25, 600)]).astype(int).tolist())
    assert 160 < quality.parting(list(two.items())) < 240
    assert quality.parting(list(Counter(r.exponential(60, 4000).astype(int).tolist()).items())) is None
    assert quality.parting([]) is None and quality.parting([(5, 9)]) is None
