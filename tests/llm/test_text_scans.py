"""Operators 6, 8 and 9 against plain versions."""

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from tillroll.llm import decontaminate as D
from tillroll.llm import license_scan as L
from tillroll.llm import pii as P

from . import helpers as H


def plain_report(docs, items, width=13):
    windows = {}
    for item, text in items:
        w = H.words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - width + 1)):
                windows.setdefault(tuple(w[i:i + width]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        w, hit, found = H.words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables(spark, sf_dir):
    docs, bench = H.fixture_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return docs, bench, [(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()]


@pytest.mark.parametrize("table_bytes", [1 << 20, 2500])
def test_decontamination_in_one_and_several_blocks(spark, monkeypatch, table_bytes):
    monkeypatch.setattr(D, "TABLE_BYTES", table_bytes)
    docs, bench, rows, items = tables(spark, "/root/testdata/sf0.001")
    want = plain_report(rows, items)
    assert sorted((tuple(r) for r in D.report(docs, bench).collect()), key=str) == want
    kept = D.uncontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(w[0] for w in want if not w[5])


def test_decontamination_of_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(D, "PASS_BYTES", 300)
    rows = [(r[0], r[1]) for r in H.odd_rows()]
    items = [(1, rows[2][1]), (1, rows[2][1]), (2, "x"), (3, "no ID at all"), (4, None), (5, " .. "), (None, "x"), (6, ""),
             (7, "wort1"), (8, "日本語")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    odd = H.odd_documents(spark)
    assert sorted((tuple(r) for r in D.report(odd, bench).collect()), key=str) == plain_report(rows, items)
    assert D.uncontaminated(odd, bench).columns == odd.columns
    assert D.report(odd, bench.limit(0)).where("contaminated").count() == 0
    assert D.report(H.empty_documents(spark), bench).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab C.ä", max_size=60), max_size=6), st.lists(st.text("ab c", max_size=12), max_size=5))
def test_search_of_any_texts(texts, items):
    import numpy as np

    items = list(enumerate(items))
    raw = [t.encode() for t in texts]
    body, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    got = D._hits(D.Searcher(items, 3), body, offsets)
    want = plain_report([(i, t) for i, t in enumerate(texts)], items, 3)
    mine = [(i, int(got[0][i]), sum(b - a for a, b in got[1][i]), len(got[2][i])) for i in range(len(texts))]
    assert sorted(mine, key=str) == [w[:4] for w in want]


def plain_base(text):
    w, starts, labels = H.words(text), [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_places_and_spans(spark, sf001):
    mit = dict(L.TEMPLATES)["mit-text"]
    broken = mit.replace("free of charge", "entirely free of any charge").replace("publish, ", "")
    extra = [(-1, f"Code. {mit} End."), (-2, f"Code. {broken} End."), (-3, "MIT License mit license, CC-BY cc by apache license"),
             (-4, "free of charge to any person and some other words"), (-5, f"{mit} {mit}"),
             (-6, "GNU General Public License gnu general public"), *[(r[0], r[1]) for r in H.odd_rows()]]
    docs = H.fixture_documents(spark, sf001).select("doc_id", "text").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string"))
    rows = L.scanned(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((str((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) for r in rows))
    assert got == sorted(str((i, *plain_base(t))) for i, t in texts)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[-1]["labels"] == by_id[-2]["labels"] == by_id[-5]["labels"] == "mit-text"
    assert by_id[-1]["score"] == 1.0 and 0.7 <= by_id[-2]["score"] < 1
    assert by_id[-3]["labels"] == "apache,cc-by,mit" and by_id[-4]["labels"] == "" and by_id[-4]["score"] == 0
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) for r in rows if r["base_labels"])
    spans = {(r["doc_id"], r["first_word"], r["end_word"]) for r in L.spans(docs).where("label = 'mit-text'").collect()}
    size = len(H.words(mit))
    assert (-1, 1, 1 + size) in spans and {(-5, 0, size), (-5, size, 2 * size)} <= spans


def test_edits_are_found_where_the_template_repeats_words(spark):
    """Words inserted into and dropped from a template with a repeated phrase; the spans by a plain alignment."""
    import difflib
    import random

    rng = random.Random(6)
    base = [f"w{i}" for i in range(22)]
    template = base[:6] + base[:4] + base[6:]  # 26 words, of which 4 are repeated
    texts = [(0, template), (1, template[:13] + ["new"] + template[13:]), (2, base), (3, ["x"] * 5 + template[:13] + ["new"] + template[13:])]
    for i in range(4, 40):
        w = list(template)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(w))
            w[at:at + rng.randrange(0, 2)] = [] if rng.random() < 0.4 else [f"n{rng.randrange(9)}"]
        texts.append((i, [f"before{k}" for k in range(rng.randrange(9))] + w + [f"after{k}" for k in range(rng.randrange(9))]))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.spans(df, (("t", " ".join(template)),)).collect()}
    assert {0, 1, 2, 3} - {2} <= set(got) and (got[1]["first_word"], got[1]["end_word"], got[1]["covered"]) == (0, 27, 26)
    assert got[3]["first_word"] == 5
    for i, w in texts:
        blocks = [b for b in difflib.SequenceMatcher(None, template, w, False).get_matching_blocks() if b.size >= L.K]
        most = max(blocks, key=lambda b: b.size) if blocks else None
        blocks = [b for b in blocks if abs((b.b - b.a) - (most.b - most.a)) <= 3]  # not the repeated phrase on its other place
        aligned = sum(b.size for b in blocks)
        if aligned >= L.MIN_TEMPLATE * len(template):
            assert i in got, (i, w)
            assert got[i]["covered"] >= aligned and got[i]["first_word"] <= blocks[0].b
            assert got[i]["end_word"] >= blocks[-1].b + blocks[-1].size


def test_license_scan_of_awkward_tables(spark):
    assert L.scanned(H.empty_documents(spark)).count() == 0
    rows = L.scanned(H.odd_documents(spark)).collect()
    assert len(rows) == len(H.odd_rows())
    plan = L.scanned(H.odd_documents(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


TEXT = ('Mail that.30@mail1.example.com or THAT.30@MAIL1.EXAMPLE.COM, +1 (437) 555-0689 and 4111-1111-1111-1111. '
        'Host 217.75.41.129; token = "ffc3105535f423f352535e4ac53b5fefe076ac6d" Mr. John Smith, Mrs Smith, господин Иванов '
        '4111111111111111 123-45-6789.')


def swap(text, key=b"k", table=None):
    out, end = [], 0
    for a, b, kind, canonical in P._entities(text):
        out += [text[end:a], P.rendered(kind, text[a:b], P.surrogate(key, kind, canonical, 0))]
        end = b
    return "".join(out) + text[end:]


def test_surrogates_keep_type_format_and_coreference():
    new = swap(TEXT)
    assert new == swap(TEXT) and new != swap(TEXT, b"other")
    for secret in ("that.30", "mail1", "437", "4111", "217.75", "ffc310", "Smith", "John", "Иванов", "123-45"):
        assert secret.lower() not in new.lower()
    shape = lambda t: [k.partition(":")[0] for _, _, k, _ in P._entities(t)]
    assert shape(new) == shape(TEXT)
    a, b = re.findall(r"[\w.]+@[\w.]+", new)
    assert a.lower() == b.lower() and b.isupper()
    cards = [re.sub(r"\D", "", x) for x in re.findall(r"(?:\d{4}-){3}\d{4}|\d{16}", new)]
    assert len(set(cards)) == 1 and P._luhn(cards[0]) == 0
    john, smith, mrs = re.search(r"Mr\. (\w+) (\w+), Mrs (\w+)", new).groups()
    assert smith == mrs and john in P.GIVEN["latin"]["m"]
    assert re.search(r"господин [а-я]", new, re.I)


def test_clean_text_is_left_alone():
    for text in ("", "Plain words, 3 numbers 12.5 and 2024-05-06, v1.2.3.", "MIT License 2.0", "Herrlich und Frauen", "mr x"):
        assert swap(text) == text


@pytest.mark.parametrize("run", ["a1", "1", "a", "é", "f", "A", "-", ".", "%", "0.", "a-", "+1 ", "@", "a@", "a@b.", "1 ", "=", '="', "key=", "Mr ",
                                 "Ab ", "日本"])
def test_runs_of_entity_characters_take_linear_time(run):
    import time

    text = run * (300_000 // len(run))
    began = time.time()
    P._entities(text)
    hinted([text])
    assert time.time() - began < 3  # what is rescanned from every start takes minutes at this length


@pytest.mark.parametrize("name", ["Παπαδόπουλος", "王小明", "אברהם", "محمد", "김철수", "たなか", "タナカ", "Հայկ", "Ärlig", "Петров"])
def test_surrogates_keep_the_script(name):
    def scripts(text):
        return {P._script(c) if P._script(c) != "accented" else "latin" for c in text if c.isalpha()}

    new = swap(f"Mr {name} wrote to {name.lower()}@例え.jp")
    who, local, host = re.fullmatch(r"Mr (\S+) wrote to (\S+)@(\S+)\.jp", new).groups()
    assert scripts(who) == scripts(local) == scripts(name) and scripts(host) == scripts("例え")
    assert who != name and local != name.lower()
    assert len({P.surrogate(b"k", P._entities(f"Mr {name}")[0][2], name.lower(), t) for t in range(30)}) == 30


def test_names_are_replaced_without_their_titles_too():
    text = "Mr John Smith and Smith met Dr. Miller; John, Smithson and a smith left, SMITH. Miller 555 123 4567 stayed. Brown too."
    new = swap(text)
    a, b, c, d, e, f, g = re.fullmatch(r"Mr (\w+) (\w+) and (\w+) met Dr\. (\w+); (\w+), Smithson and a smith left, SMITH\. "
                                       r"(\w+) (\d{3} \d{3} \d{4}) stayed\. Brown too\.", new).groups()
    assert b == c != "Smith" and a == e != "John" and d == f != "Miller" and g != "555 123 4567"
    assert swap("Smith and John") == "Smith and John"
    assert [x[:2] for x in P._entities(text)] == sorted(x[:2] for x in P._entities(text))


def redone(monkeypatch):
    """Surrogates of telephone numbers from a space so small that they collide."""
    real = P.surrogate

    def few(key, kind, canonical, attempt):
        if kind.startswith("phone"):
            return "1" + f"{P.Draw(key, kind, canonical, attempt).below(40):010d}"
        return real(key, kind, canonical, attempt)
    monkeypatch.setattr(P, "surrogate", few)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_collisions_are_drawn_anew(spark, monkeypatch, bound):
    monkeypatch.setattr(P, "EXCEPTIONS_BROADCAST", bound)
    redone(monkeypatch)
    texts = [(i, f"call +1 ({200 + i}) 555-0100 or +1 ({200 + (i + 1) % 25}) 555-0100 now") for i in range(25)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    out = {r["doc_id"]: re.findall(r"\+1 \(\d+\) [\d-]+", r["text"]) for r in P.report(df).collect()}
    first = {i: v[0] for i, v in out.items()}
    assert len(set(first.values())) == 25
    assert all(v[1] == first[(i + 1) % 25] for i, v in out.items())


def test_pii_of_tables(spark, sf001):
    docs = H.fixture_documents(spark, sf001)
    out = P.replaced(docs)
    assert out.schema == docs.schema
    old, new = ({r["doc_id"]: r for r in x.collect()} for x in (docs, out))
    secrets = {c for r in old.values() for _, _, _, c in P._entities(r["text"] or "")}
    for i, r in new.items():
        found = P._entities(old[i]["text"] or "")
        if not found:
            assert r == old[i]
        else:
            assert r["n_chars"] == len(r["text"]) and len(P._entities(r["text"])) == len(found)
            assert not {c for _, _, _, c in P._entities(r["text"])} & secrets
    odd = H.odd_documents(spark)
    assert sorted(map(str, P.replaced(odd).collect())) == sorted(map(str, odd.collect()))
    assert P.report(H.empty_documents(spark)).count() == 0


def hinted(texts):
    import numpy as np

    raw = [t.encode() for t in texts]
    return P._hinted(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


WITHOUT_ASCII_DIGITS = [
    'password = "correcthorsebattery"', "TOKEN:\u2003'abcdefgh'", 'api\u212aey="abcdefgh"', '"\u017fecret" : "abcdefgh"',
    "call (٤٣٧) ٥٥٥-٠٦٨٩", "१२३-४५-६७८९", "４１１１１１１１１１１１１１１１", "abcdefab" * 4, "ABCDEFAB" * 4, "Señora Ruiz", "x@example.com"]


def test_every_text_with_an_entity_is_searched(spark):
    for text in WITHOUT_ASCII_DIGITS:
        assert P._entities(text) and hinted(["abcdefabcdef", text, "a="]).count(1) == 1, text
    df = spark.createDataFrame(list(enumerate(WITHOUT_ASCII_DIGITS)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in P.report(df).collect()}
    assert all(out[i]["n_replaced"] and out[i]["text"] != t for i, t in enumerate(WITHOUT_ASCII_DIGITS))


@pytest.mark.parametrize("end", ["=", ":", "key ="])
def test_an_assignment_hides_no_digits_of_the_next_row(end):
    text = "４" * 16 + '"'
    assert P._entities(text) and hinted(["abc", end, text, "abc"]) == [1, 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from([*WITHOUT_ASCII_DIGITS, "key", '"', "'", "=", ":", "abcdef" * 3, "Mr", "Herr"]),
                                   st.text(max_size=9)), max_size=5).map("".join), max_size=5))
def test_hints_of_any_texts(texts):
    assert {i for i, t in enumerate(texts) if P._entities(t)} <= set(hinted(texts))


def surrogates_of(spark, found):
    df = spark.createDataFrame(found, "kind string, canonical string")
    return {(r["kind"], r["canonical"]): r for r in P.attempts(df, b"k").collect()}


def test_more_names_than_the_pool_of_given_names(spark):
    found = [("given:latin:m", f"name{i}") for i in range(6000)] + [("given:cyrillic:f", f"имя{i}") for i in range(3000)]
    got = surrogates_of(spark, found)
    assert len(got) == 9000 == len({r["surrogate"] for r in got.values()})
    assert all(r["surrogate"] == P.surrogate(b"k", *k, r["attempt"]) for k, r in got.items())


def test_crowded_and_full_formats_get_free_values(spark):
    found = [("email", f"{c}@example.com") for c in "abcdefghijklmnopqrstuvwxyz"]  # every value of the format
    found += [("email", f"{c}@x.com") for c in "abcdefghijklmnopqrstuvwxyz"] + [("email", "-@y.com"), ("secret", "--------")]
    found += [("phone:1", f"1{i:03d}") for i in range(600)]  # of 800 values, 400 are left
    found += [("card", "4111111111111111"), ("card", "4111111111111112"), ("ssn", "123456789"), ("ip", "1.2.3.4")]
    found = sorted(set(found))
    got = surrogates_of(spark, found)
    assert set(got) == set(found)
    for kind in ("email", "phone", "secret"):
        new = [r["surrogate"] for (k, _), r in got.items() if k.startswith(kind)]
        assert len(set(new)) == len(new) and not set(new) & {c for k, c in found if k.startswith(kind)}
    assert all(r["surrogate"] == P.surrogate(b"k", *k, r["attempt"]) for k, r in got.items())
    phones = [r["surrogate"] for (k, _), r in got.items() if k == "phone:1"]
    free = {f"1{i:03d}" for i in range(200, 1000)} - {c for k, c in found if k == "phone:1"}
    assert free <= set(phones) and all(p[0] == "1" for p in phones)  # longer ones only when all others are used
    assert P.rendered("phone:1", "+1 234", "12345") == "+1 2345"


@pytest.mark.parametrize("kind, canonical", [
    ("email", "a.b@x.com"), ("phone:1", "1234"), ("ssn", "123"), ("card", "42"), ("card", "41"), ("secret", "a1"),
    ("secret", "Xy"), ("secret", "-½"), ("ip", "1.2.3.4"), ("secret", "σ-")])
def test_values_of_a_format_are_listed_once(kind, canonical):
    size = min(3000, P.math.prod(map(len, P._format(b"k", kind, canonical)[1])) * 3)
    values = [P._nth(b"k", kind, canonical, n) for n in range(size)]
    assert len(set(values)) == size
    if kind == "card":
        assert all((P._luhn(v) == 0) == (P._luhn(canonical) == 0) for v in values)
