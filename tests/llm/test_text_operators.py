import random
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quillpanel.llm import contamination, fingerprint, mojibake, skeleton


# ---------------------------------------------------------------- problem 2
@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("ＡＬ－ＫＨＡＩＭ", "AL-KHAIM"),
        ("Zayer Lidraskîk", "Zayer Lidraskîk"),
        ("GIM‌IGHAIL ​TROW­AM", "GIMIGHAIL TROWAM"),
        ("Motrok Dririzous  X", "Motrok Dririzous  X"),
        ("El‐Ghi El‑Ri", "El-Ghi El-Ri"),
        ("PIGHÔL DЕGАVЕ", "PIGHÔL DEGAVE"),
        ("ΥΑΙΥΟUΝΚU ВЕN", "YAIYOUNKU BEN"),
        ("rapus ziνiñghas", "rapus ziviñghas"),
        ("Мотрок Гивэйкзам Бэн Вухорсус", "Мотрок Гивэйкзам Бэн Вухорсус"),
        ("Мотрок Гивэйкзaм", "Мотрок Гивэйкзам"),
        ("موكلا خوهيل", "موكلا خوهيل"),
        ("", ""),
    ],
)
def test_consistent_form(text, clean):
    got = skeleton.consistent_form(text)
    assert got == clean
    assert skeleton.consistent_form(got) == got


def test_the_public_table_of_look_alikes():
    assert len(skeleton.prototypes()) > 6000
    for likes in (("ANNA", "ꓮNNA", "ΑNNA", "АNNA"), ("gara", "ɡara"), ("OMAR", "ⲞMAR", "0MAR", "ОMAR"), ("via", "ѵia"), ("lid", "Iid", "1id"), ("كريم", "کریم")):
        assert len({skeleton.skeleton(t) for t in likes}) == 1, likes
    assert [skeleton.consistent_form(t) for t in ("ɡara", "ꓮLI", "ⲞMAR", "ѵIA", "كريم", "ıldız")] == ["gara", "ALI", "OMAR", "vIA", "كريم", "ıldız"]


def test_skeletons_of_ascii_are_the_same_in_the_engine(spark):
    texts = ["".join(map(chr, range(0x20, 0x7F))), "Mimi 10|l", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(skeleton.ascii_skeleton(df["t"])).collect()] == [skeleton.skeleton(t) for t in texts]


def test_equal_skeletons_of_what_looks_the_same():
    assert len({skeleton.skeleton(t) for t in ("SATI", "ЅАТІ", "ＳＡＴＩ", "SA​TI")}) == 1
    assert skeleton.skeleton("SATI") != skeleton.skeleton("SATÎ")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcAÉéñΑаЕе ​ -‐ｆ́", max_size=12))
def test_form_is_stable_and_composed(text):
    form = skeleton.consistent_form(text)
    assert skeleton.consistent_form(form) == form == unicodedata.normalize("NFC", form) and "​" not in form and " " not in form
    assert skeleton.skeleton(form) == skeleton.skeleton(text)


def test_differing_names_and_groups(spark):
    df = spark.createDataFrame([(1, "ANА B"), (2, "ANA B"), (3, None), (4, ""), (5, "Zoé"), (1, "ANА B")], "k long, name string")
    df = df.selectExpr("k", "name", "1 AS tbl", "2 AS row_id", "3 AS text", "4 AS skel")
    got = sorted(map(tuple, skeleton.differing_names({"t": (df, "k", "name")}).collect()))
    assert got == [("t", 1, "ANA B"), ("t", 1, "ANA B")]
    assert [(r.n_rows, r.n_forms, r.clean_name) for r in skeleton.skeleton_groups({"t": (df, "k", "name")}).collect()] == [(3, 2, "ANA B")]
    assert skeleton.differing_names({"t": (df.limit(0), "k", "name")}).count() == 0
    long = spark.createDataFrame([(1, "а" * 5 + "b" * 300_000)], "k long, name string")
    assert len(skeleton.differing_names({"t": (long, "k", "name")}).first().clean_name) == 300_005


# ---------------------------------------------------------------- problem 3
ENTRY = "row_id long, assess_group string, wave int, st_id string, uniqueid string, age int, grade int, q11 int, q12 int, q1_99 int, score double, first long, n_copies int"


def copies(spark, *entries):
    df = spark.createDataFrame([(i, "G", 1, s, u, a, 1, 0, 0, None, x, 0, 0) for i, (s, u, a, x) in enumerate(entries, 1)], ENTRY)
    return {r["first"]: r.n_copies for r in fingerprint.collapse_copies(df, "row_id", fingerprint.assessment_record(df), ["st_id", "uniqueid"]).collect()}


def test_copies_written_differently(spark):
    got = copies(
        spark, ("AREM1", "EGRA-T35-000007800", 9, 1.5), (" a.rem 1", "000007800–t35–egra", 9, 1.5), ("AREM1", "T35EGRA000007800", 9, 1.5), ("AREM1", "EGRAT35000007800", None, 1.5), ("arem-1", "egra_t35_000007800", None, 1.5),
        ("AREM1", "EGRA-T53-000007800", 9, 1.5), (None, "EGRA-T35-000007800", 9, 1.5), (None, "EGRA-T35-000007800", 9, 1.5), ("AREM1", "EGRA-T35-000007800", 9, None), ("AREM1", "EGRA-T35-000007800", 9, None),
    )
    assert got == {1: 3, 4: 2, 6: 1, 9: 2}
    assert copies(spark) == {}


def test_collisions_are_split(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(fingerprint, "_pair_hash", lambda name, value, lane: F.lit(0).cast("long"))
    assert copies(spark, ("A", "EGRA-T35-000007800", 9, 1.0), ("B", "EGRA-T35-000007800", 9, 1.0), ("A", "EGRA-T35-000007800", 9, 1.0)) == {1: 2, 2: 1}


def test_fields_are_verified_as_values(spark, monkeypatch):
    from pyspark.sql import functions as F

    # two ids made so that xxhash64 agrees for both lanes' seeds and for those of the whole-record hashes there once were
    pad = "A" * 24
    one, two = f"9PDFYGSR{pad}DI6J13JC{pad}", f"9PDFYGSP{pad}DI6QTS99{pad}"
    entries = [(s, "EGRA-T35-000007800", 9, 1.5) for s in (one, two, one.lower())]
    lanes = fingerprint.multiset_fingerprint({"st_id": F.col("s")})
    assert spark.createDataFrame([(one,), (two,)], "s string").select(*lanes).distinct().count() == 1
    assert copies(spark, *entries) == {1: 2, 2: 1}

    # whatever is hashed, equal hashes make no copies
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(0).cast("long"))
    others = [("A", "EGRA-T35-000007800", 9, 1.5), ("A", "EGRA-T35-000007800", None, 1.5), ("A", "EGRA-T35-000007800", None, None), ("A", "EGRA-T35-000007801", 9, 1.5)]
    assert copies(spark, *entries, *others, *others[1:3]) == {1: 2, 2: 1, 4: 1, 5: 2, 6: 2, 7: 1}


# ---------------------------------------------------------------- problem 8
def brute(documents, items, window):
    index = {}
    for i, t in items:
        w = contamination.words_of(t)
        for k in range(len(w) - window + 1):
            index.setdefault(tuple(w[k : k + window]), set()).add(i)
    return {(d, i) for d, t in documents for w in [contamination.words_of(t)] for k in range(len(w) - window + 1) for i in index.get(tuple(w[k : k + window]), ())}


def test_leaks_against_brute_force(spark):
    import random

    rng = random.Random(4)
    vocabulary = [f"w{i}é" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(6)]
    documents = [(d, " ".join(rng.choices(vocabulary, k=20))) for d in range(30)]
    for d in range(0, 30, 3):
        words = contamination.words_of(items[d % 6][1])
        at = rng.randrange(10)
        documents[d] = (d, "X, " + " — ".join(w.upper() for w in words[at : at + rng.randrange(10, 18)]) + " the end")
    documents += [(100, None), (101, ""), (102, "short"), (0, documents[0][1])]
    items += [(50, None), (51, "too short"), (52, items[0][1])]
    docs = spark.createDataFrame(documents, "k long, body string").selectExpr("k", "body", "1 AS doc", "2 AS item", "3 AS t")
    tests = spark.createDataFrame(items, "k long, body string")
    expected = brute([(d, t) for d, t in documents], [(i, t) for i, t in items], 12)
    for how in ({}, {"piece_words": 13}, {"max_block_windows": 20}):
        found = contamination.find_leaks(docs, "k", "body", tests, "k", "body", **how)
        assert {(r.doc, r.item) for r in found.collect()} == expected and expected
    assert contamination.find_leaks(docs.limit(0), "k", "body", tests, "k", "body").count() == 0
    assert contamination.find_leaks(docs, "k", "body", tests.limit(0), "k", "body").count() == 0


def test_near_windows_and_index_guarantee(spark):
    import numpy as np

    words = [f"q{i}" for i in range(40)]
    changed = [*words[:20], "other", *words[21:]]
    docs = spark.createDataFrame([(1, " ".join(changed))], "k long, body string")
    tests = spark.createDataFrame([(7, " ".join(words))], "k long, body string")
    near = contamination.find_leaks(docs, "k", "body", tests, "k", "body", window=25, radius=12, min_similarity=0.3).first()
    assert near.item == 7 and 0.3 <= near.similarity < 1
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    index = contamination.ItemIndex(12, 3, base, np.zeros((200, 12), np.uint64), np.arange(200), {}).prepare()
    probes = base.copy()
    for i in range(200):
        for bit in rng.choice(64, i % 5, replace=False):
            probes[i] ^= np.uint64(1) << np.uint64(bit)
    doc, item = index.candidates(probes)
    found = set(zip(doc.tolist(), item.tolist(), strict=True))
    every = {(i, j) for i in range(200) for j in range(200) if int(probes[i] ^ base[j]).bit_count() <= 3}
    assert found == every and len(every) >= 160


def test_near_windows_of_25_words_are_all_found(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    phrase = rng.choices(vocabulary, k=30)
    items = [(i, rng.choices(vocabulary, k=40)) for i in range(8)]
    items += [(8, [*phrase, *items[0][1]]), (9, [*phrase, *items[1][1]]), (10, vocabulary[:3] * 14)]
    documents = []
    for d in range(120):
        words = list(items[d % 11][1])
        at = rng.randrange(len(words) - 27)
        words = words[at : at + rng.randrange(25, 28)]
        if d % 4:
            words[rng.choice([0, 1, 2, 12, -3, -2, -1])] = "other"  # one word at an edge leaves the window similar
        documents.append((d, [*rng.choices(vocabulary, k=rng.randrange(9)), *words, *rng.choices(vocabulary, k=9)]))
    index = contamination.index_items(items, 25, 3)
    common = float(contamination.np.log1p(1))
    every, changed = {}, set()
    for d, words in documents:
        hashes = contamination.word_hashes(words)
        for at in range(len(hashes) - 24):
            for window, item in zip(index.words, index.item.tolist(), strict=True):
                s = contamination._similarity(hashes[at : at + 25], window, index.weights, common)
                if s >= 0.8 - 1e-9:
                    n, most = every.get((d, item), (0, 0.0))
                    every[d, item] = (n + 1, max(most, s))
    changed = [k for k, (_, most) in every.items() if most < 1]
    docs, tests = (spark.createDataFrame([(k, " ".join(w)) for k, w in x], "k long, body string") for x in (documents, items))
    for how in ({}, {"piece_words": 26}):
        found = contamination.find_leaks(docs, "k", "body", tests, "k", "body", window=25, min_similarity=0.8, **how).collect()
        got = {(r.doc, r.item): (r.n_windows, pytest.approx(r.similarity)) for r in found}
        assert set(got) == set(every) and len(changed) >= 30
        assert how or got == every


# ---------------------------------------------------------------- problem 10
FRENCH = "L’équipe est arrivée à l’école Şulim — « prête » à 9 €…"
ARABIC = "وصل الفريق إلى المدرسة، وقال: نعم؟"


@pytest.mark.parametrize("text", [FRENCH, ARABIC])
@pytest.mark.parametrize("chain", [("cp1252",), ("latin-1",), ("cp1250",), ("cp1251",), ("cp1256",), ("mac_roman",), ("cp437",), ("cp1252", "cp1252"), ("latin-1", "latin-1"), ("cp1252", "latin-1")])
def test_damage_is_undone(text, chain):
    assert mojibake.restore(mojibake.garbled(text, chain)) == text


def test_only_matched_spans_change():
    assert mojibake.restore("café, 20Â°C and naÃ¯ve") == "café, 20°C and naïve"
    for good in (FRENCH, ARABIC, "فقط، نعم", "LÃO / SÃO", "±3 µg, 5 ¼ h", "¿quién? © 2018", "Ø = moyenne", "£12 (12 €)", "château âgé", "", " ", None, "plain"):
        assert mojibake.restore(good) is None


def test_lost_characters():
    for bad in ("means �refused� here", "tap âskipâ. naÃ¯ve", "le prix de 7 â¬ par mois, cafÃ©", "Ãcole CafÃ©", "The supervisorâs remark and the cafÃ© owner"):
        assert mojibake.restore(bad) == mojibake.LOST
    assert mojibake.restore("Drâigeis Ben. Il a marquÃ©e un but.") == "Drâigeis Ben. Il a marquée un but."


def test_question_marks_in_place_of_letters():
    for bad in ("the carpenter?s shed", "Le ma?tre a gardé 25 cahiers", "at ?cole Primaire", "caf? et d?p?t"):
        assert mojibake.restore(bad) is mojibake.LOST
    for good in ("Why? Because.", "see http://a.b/c?d=e&f=g and www.x.org/?q", "who?! ?", "¿quién?", "(?) 3?4"):
        assert mojibake.restore(good) is None


@pytest.mark.parametrize("text", ["great 😀 fun", "שלום עולם", "こんにちは", "Привет, мир"])
@pytest.mark.parametrize("chain", [("cp1252",), ("latin-1",), ("cp1251",), ("mac_roman",), ("cp437",), ("cp1257",), ("cp866",)])
def test_other_scripts(text, chain):
    assert mojibake.restore(mojibake.garbled(text, chain)) == text


def test_both_kinds_of_damage_are_undone():
    arabic = "قال المشرف إن المدرسة القديمة"
    assert mojibake.restore(arabic.encode("cp1256").decode("cp1252") + ". cafÃ© and naÃ¯ve") == arabic + ". café and naïve"


def test_restored_texts(spark):
    df = spark.createDataFrame([(1, "cafÃ©"), (2, None), (3, "ok"), (4, "x�"), (1, "cafÃ©"), (5, "é" * 200_000 + "Ã©"), (6, "na?ve"), (7, "loÃ©st")], "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS t", "3 AS restored", "4 AS lost")
    got = sorted((r.doc_id, (r.restored or "gone")[-4:], r.lost) for r in mojibake.restored_texts(df, "doc_id", "text").collect())
    assert got == [(1, "café", False), (1, "café", False), (4, "gone", True), (5, "éééé", False), (6, "gone", True), (7, "oést", False)]
    assert mojibake.restored_texts(df.limit(0), "doc_id", "text").count() == 0


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="abc éèàçêîôûñ’“”—€Ş", min_size=3, max_size=40), st.sampled_from([("cp1252",), ("latin-1",), ("cp1251",), ("mac_roman",), ("cp437",)]))
def test_round_trip(text, chain):
    damaged = mojibake.garbled(text, chain)
    if damaged != text:
        assert mojibake.restore(damaged) == text


def test_single_byte_arabic_read_as_latin():
    original = "قال المشرف إن 33 استمارة موقعة وصلت، وما زالت 17 ناقصة في Ecole à Sète."
    damaged = original.encode("cp1256").decode("cp1252")
    assert mojibake.restore(damaged) == original
    assert mojibake.restore("Oui. " + damaged + " Voilà l’été.") == "Oui. " + original + " Voilà l’été."


def test_short_texts_of_long_words_are_searched(spark):
    # four signs that decompose to four words each are a passage of sixteen words
    words = " ".join(contamination.words_of("\ufdfa " * 4))
    assert len(words.split()) >= 12
    docs = spark.createDataFrame([(1, "\ufdfa \ufdfa \ufdfa \ufdfa"), (2, "\ufdfa")], "k long, body string")
    items = spark.createDataFrame([(7, words)], "k long, body string")
    assert [(r.doc, r.item) for r in contamination.find_leaks(docs, "k", "body", items, "k", "body").collect()] == [(1, 7)]


def test_windows_are_fingerprinted_alike_one_by_one():
    shingles = contamination.shingle_hashes(contamination.word_hashes([f"w{i % 37}" for i in range(400)]))
    every = contamination.window_fingerprints(shingles, 8)
    at = contamination.np.array([0, 3, 50, 51, 300])
    assert (contamination.fingerprints_at(shingles, at, 8) == every[at]).all() and len(contamination.fingerprints_at(shingles, at[:0], 8)) == 0
