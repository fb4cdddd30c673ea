"""Entities are replaced whole: names beyond two words or without titles, secrets and addresses of any length."""

import itertools
import random
import time

import numpy as np
import pytest

from talkmill.llm import surrogates

NAMES = [
    ("Dr. Anna Maria Schmidt came.", "Anna Maria Schmidt"),
    ("Frau Müller-Lüdenscheidt kam.", "Müller Lüdenscheidt"),
    ("Mr. John F. Kennedy spoke.", "John F Kennedy"),
    ("Mr. J. Smith left. Then Smith came back.", "J Smith Smith"),
    ("Prof. Dr. Hans Meier kam. Dr House.", "Hans Meier House"),
    ("Prof. Dr. med. Hans-Peter Meier kam", "Hans Peter Meier"),
    ("Mrs. O'Brien's house, Mr. D'Angelo's too", "O'Brien D'Angelo"),
    ("Frau Anna von der Leyen sagte, Leyen", "Anna Leyen Leyen"),
    ("Señora De La Cruz", "De La Cruz"),
    ("yesterday Clara Jones met Paul.", "Clara Jones Paul"),
    ("Иван Петрович Сидоров пришёл", "Иван Петрович Сидоров"),
    ("Mr. Smith. Please call", "Smith"),
    ("Anna And The King", "Anna"),
    ("I saw a frank maria 12", ""),
]


@pytest.mark.parametrize("text, want", NAMES)
def test_whole_names(text, want):
    assert " ".join(text[a:b] for a, b, kind in surrogates.find(text) if kind == "name") == want


def test_initials_change():
    s = surrogates.Surrogates(b"k")
    assert sorted(s.name(c) for c in "BCDFGHJKLMNPQRSTVWXYZ") == list("BCDFGHJKLMNPQRSTVWXYZ") and any(s.name(c) != c for c in "BCDF")


LONG = random.Random(5)
TOKEN = "".join(LONG.choices("abcdefgh0123456789", k=200))
ENTITIES = [
    ("token=%s", TOKEN, "secret"),
    ("token=%s.", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.abc-DEF_123", "secret"),
    ("key %s.", "".join(LONG.choices("0123456789abcdef", k=300)), "secret"),
    ("key %s.", "".join(LONG.choices("0123456789ABCDEF", k=3000)), "secret"),
    ("password: '%s'", "x1" * 50_000, "secret"),
    ("to %s,", "a" * 80 + "@mail.example.org", "email"),
    ("to %s,", "me@" + ".".join("abcdefghijklm") + ".org", "email"),
    ("to %s,", "me@" + "x" * 90 + ".org", "email"),
]


VALUES = [
    ("password=%s x", "hunter22!secretpart9", "secret"),
    ("token=%s", "abcdef12#rest99", "secret"),
    ("pwd=%s,", "12345678@home", "secret"),
    ("secret: %s", "AAAAAAAA1,BBBB2222", "secret"),
    ("password: %s.", "Pa$$w0rd!x9", "secret"),
    ("password=%s", "hünter2222", "secret"),
    ('api_key="%s" z', "abc def123456", "secret"),
    ("{'token': '%s', 'x': 1}", "a b.c,d 12", "secret"),
    ("(token=%s)", "xyz12345", "secret"),
    ("call %s.", "+49 30 123456-78", "phone"),
    ("call %s.", "+1 (017) 555-7713", "phone"),
    ("Tel. %s, bitte", "030 1234567", "phone"),
    ("Tel. %s, bitte", "(030) 123456", "phone"),
    ("Tel. %s, bitte", "0171/1234567", "phone"),
    ("tél %s.", "01 23 45 67 89", "phone"),
    ("tel %s;", "612 345 678", "phone"),
    ("tel %s;", "91 123 45 67", "phone"),
    ("at %s,", "2001:db8::1", "ip"),
    ("at %s.", "FE80:0:0:0:1:2:3:4", "ip"),
    ("iban %s", "de89370400440532013000", "iban"),
    ("IBAN %s", "DE89 3704 0044 0532 0130 00", "iban"),
]


@pytest.mark.parametrize("frame, entity, kind", VALUES)
def test_whole_values(frame, entity, kind):
    text = frame % entity
    assert [(text[a:b], k) for a, b, k in surrogates.find(text)] == [(entity, kind)]
    new = getattr(surrogates.Surrogates(b"k"), kind)(entity)
    form = lambda s: "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in s) if kind not in ("ip", "iban") else len(s)
    assert new != entity and form(new) == form(entity) and [k for *_, k in surrogates.find(frame % new)] == [kind]


@pytest.mark.parametrize("text", ["in 2019-2020 or 1000 000 000", "at 12:34:56", "std::vector a::b ::", "version 1.0.12 34", "03 12 2024", "pages 01-23", "the token: none", "password: see below", "x" * 30 + ":1:2"])
def test_what_is_nobodys_stays(text):
    assert surrogates.find(text) == []


def test_long_secrets_follow_the_rules_of_short_ones():
    """What isn't hex never comes out as hex, whatever its length; hex with letters keeps some."""
    s = surrogates.Surrogates(b"k")
    p = s.permute
    calls = []

    class Watched(surrogates.Permutation):
        def long(self, kind, values, sizes):
            calls.append(kind)
            return np.zeros_like(values) if len(calls) == 1 else surrogates.Permutation.long(self, kind, values, sizes)

    s.permute = Watched(p.key)
    new = s.letters("secret", "g1" * 600, allowed=lambda x: not surrogates._HEX.fullmatch(x))
    assert len(calls) == 2 and not surrogates._HEX.fullmatch(new)
    calls.clear()
    assert not s.secret("a1" * 600).isdigit() and len(calls) == 2


def test_many_names_take_one_walk():
    r = random.Random(1)
    names = ["".join(r.choices("abcdefghijklmnop", k=r.randint(3, 9))).capitalize() for _ in range(60_000)]
    text = "".join(f"Mr. {n} met O'Brien. " for n in ["O'Brien", *names])
    began = time.time()
    found = surrogates.find(text)
    assert len(found) > 1.99 * len(names) and time.time() - began < 30
    text = "Mr. O'Brien, Mr. O and Mr. Ann. O'Briens O'Brien O Ann Anna xAnn Ann's"
    assert [text[a:b] for a, b, _ in surrogates.find(text)] == ["O'Brien", "O", "Ann", "O'Brien", "Ann", "Anna", "Ann"]


@pytest.mark.parametrize("frame, entity, kind", ENTITIES)
def test_whole_entities(frame, entity, kind):
    text = frame % entity
    assert [(text[a:b], k) for a, b, k in surrogates.find(text)] == [(entity, kind)]
    s = surrogates.Surrogates(b"k")
    new = getattr(s, kind)(entity)
    assert len(new) == len(entity) and new != entity and new == getattr(surrogates.Surrogates(b"k"), kind)(entity)
    other = entity[:20] + ("c" if entity[20] != "c" else "d") + entity[21:]
    assert getattr(s, kind)(other) != new


def test_long_strings_are_permuted_one_to_one():
    p, sizes = surrogates.Permutation(b"k" * 32), np.array([2, 3, 5, 4])
    grid = np.stack(np.meshgrid(*map(np.arange, sizes), indexing="ij"), -1).reshape(-1, 4)
    assert {tuple(p.long("x", v, sizes).tolist()) for v in grid} == set(map(tuple, grid.tolist()))


def test_many_signs_take_no_time():
    began = time.time()
    for text in ("a@" * 50_000, "Mr. " + "Smith-" * 20_000, "a." * 50_000 + "@", "token=" + "a.=" * 50_000, "Anna " * 20_000):
        surrogates.find(text)
    assert time.time() - began < 10


WORDS = "Brown Smith Li Ng Bareto Öz Łęć Müller René Nguyễn Иванов Иванова Достоевская Їжакевич Шевченко Παπαδόπουλος Σωκράτης محمد أحمد 王伟 張偉明 김 이민호 やまだ हरि שרה O'Brien D'Angelo McDonald J Ö Я".split()


@pytest.mark.parametrize("key", range(200))
def test_no_name_stays(key):
    s = surrogates.Surrogates(str(key).encode())
    listed = [n for names in surrogates.GIVEN.values() for n in names]
    for word in [*listed, *WORDS]:
        new = s.name(word)
        assert new.lower() != word.lower() and (new.lower() in surrogates.GENDERS) == (word.lower() in surrogates.GENDERS)
    assert len({s.name(w) for w in [*listed, *WORDS]}) == len(set(listed + WORDS))
    for names in surrogates.GIVEN.values():
        assert sorted(map(s.name, names)) == sorted(names)


def test_short_words_have_surrogates_of_their_own():
    s = surrogates.Surrogates(b"k")
    latin = ["".join(x) for n in (2, 3) for x in itertools.product("abdeinorst", repeat=n)] + [a + v + "ri" + e for a in "lmns" for v in "aeiou" for e in "aeon"] + ["á" + x for x in "abcné"]
    cyrillic = ["".join(x) + e for n in (1, 2, 3) for x in itertools.product("авионьё", repeat=n) for e in ("ва", "а", "на", "ский", "ская", "в", "й", "я")]
    for words in (latin, cyrillic):
        words = sorted(set(words) - set(surrogates.GENDERS))
        new = [s.name(w) for w in words]
        assert len(set(new)) == len(words) and not any(a == b for a, b in zip(words, new)) and not set(new) & set(surrogates.GENDERS)
    assert s.name("Иванова").endswith("ва") and s.name("Достоевский").endswith("ский") and s.name("BROWN").isupper()


@pytest.mark.parametrize("kind, make", [("phone", lambda i: f"+1 ({i:03d}) 555"), ("ssn", lambda i: f"{i:03d}-45-6789"), ("secret", lambda i: f"{i:03d}"), ("secret", lambda i: f"a{i % 10}"), ("secret", lambda i: f"A{i % 10}"), ("secret", lambda i: f"z{i % 10}x"), ("ip", lambda i: f"10.0.0.{i % 256}"), ("email", lambda i: f"{i}@x.org")])
def test_no_entity_stays(kind, make):
    for key in range(20):
        s = surrogates.Surrogates(bytes([key]))
        texts = sorted({make(i) for i in range(1000)})
        new = [getattr(s, kind)(t) for t in texts]
        assert len(set(new)) == len(texts) and not any(a == b for a, b in zip(texts, new))


def test_hex_and_other_secrets_dont_meet():
    s = surrogates.Surrogates(b"k")
    texts = ["".join(x) for x in itertools.product("0aAz", repeat=3)]
    assert len({s.secret(t) for t in texts}) == len(texts)


def test_the_query_against_a_plain_version(spark, tmp_path):
    """Outside the spans nothing changes; inside, one plain pass over all rows gives the same surrogates, and finds no two originals in one."""
    from talkmill.llm import queries

    texts = ["Mr. 王伟 met Dr Öz and Herr Brown. Brown left.", "Frau Łęć: +1 (017) 555-7713, BROWN said. Mr. BROWN", None, "", "Mrs Vera Smith and Олег Иванов, smith@x.org", "token = 04dbebab91ab85687d33eeaaf9ac699e1188f962"] * 2
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op5_surrogates(spark, str(tmp_path)).collect()}
    make, seen = surrogates.Surrogates(queries.SURROGATE_KEY), {}
    for i, text in enumerate(texts):
        want, at, kinds = "", 0, set()
        for a, b, kind in surrogates.find(text or ""):
            new = getattr(make, kind)(text[a:b])
            assert new != text[a:b] and seen.setdefault((kind, new.lower() if kind == "name" else new), text[a:b].lower() if kind == "name" else text[a:b]).lower() == text[a:b].lower()
            want, at = want + text[at:a] + new, b
            kinds.add(kind)
        assert got[i]["text"] == (None if text is None else want + text[at:]) and got[i]["kinds"] == ",".join(sorted(kinds)) and got[i]["n_collisions"] == 0
        assert got[i]["n_entities"] == len(surrogates.find(text or ""))
    assert got[0]["n_entities"] == 4


def test_collisions_are_counted(spark):
    span = "array<struct<start:long,length:long,kind:string,surrogate:string,original_hash:string>>"
    rows = [(1, [(0, 1, "name", "Bo", "h1"), (2, 1, "email", "q", "h4")]), (2, [(0, 1, "name", "BO", "h2")]), (None, [(0, 1, "name", "bo", "h1")]), (4, [(0, 1, "secret", "Bo", "h3")]), (5, [])]
    df = spark.createDataFrame(rows, f"doc_id int, spans {span}")
    assert [tuple(r) for r in surrogates.collisions(df).collect()] == [("name", "bo", 2)]
    assert {r["doc_id"]: r["n_collisions"] for r in surrogates.with_collisions(df).collect()} == {1: 1, 2: 1, None: 1, 4: 0, 5: 0}
