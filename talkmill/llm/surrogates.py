"""Personal data: entities are found and replaced by keyed surrogates of the same kind and form."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from ipaddress import ip_address

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ready, unused
from .quality import COMMON_WORDS

#: Titles that announce a name, with the gender that they tell; and given names by script and gender.
TITLES = {"mr": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "господин": "m", "mrs": "f", "ms": "f", "miss": "f", "frau": "f", "mme": "f", "madame": "f", "señora": "f", "sra": "f", "госпожа": "f", "dr": "", "prof": ""}
GIVEN = {
    ("latin", "f"): "Alice Anna Beatrice Carla Claire Clara Diana Elena Emma Eva Helen Ines Irene Julia Laura Lucia Maria Marie Martha Nina Olga Paula Rosa Sarah Sofia Teresa Vera".split(),
    ("latin", "m"): "Adam Albert Andrew Anton Bruno Charles Daniel David Edward Frank Georg Henry Hugo James John Jonas Juan Karl Leo Louis Martin Max Oscar Paul Peter Robert Thomas Victor".split(),
    ("cyrillic", "f"): "Алла Анна Вера Дарья Елена Инна Ирина Мария Нина Ольга Светлана Софья".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Денис Иван Игорь Лев Максим Олег Павел Пётр Роман".split(),
}
GENDERS = {name.lower(): key for key, names in GIVEN.items() for name in names}
#: Letters that stand for each other: of one script and case, vowels for vowels.
ALPHABETS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ"]
CLASS_OF = {c: a for a in ALPHABETS for c in a}
#: Blocks of letters that are one alphabet each: Chinese characters and Korean syllables. Other letters share one with those of their kind in the same 256 places.
WIDE = [range(0x4E00, 0x9FA6), range(0xAC00, 0xD7A4)]
_blocks: dict[tuple[int, str], str] = {}


def class_of(c: str) -> str | None:
    """The alphabet that a letter, mark or digit belongs to; null for other signs. The alphabets part all characters among them, and none has a letter alone but where Unicode has no like."""
    if c in CLASS_OF:
        return CLASS_OF[c]
    kind = unicodedata.category(c)
    if c < "\x80" or kind[0] not in "LM" and kind != "Nd":
        return None
    block = next((r for r in WIDE if ord(c) in r), range(ord(c) & ~255, (ord(c) | 255) + 1))
    key = block.start, kind
    if key not in _blocks:
        _blocks[key] = "".join(x for x in map(chr, block) if x not in CLASS_OF and unicodedata.category(x) == kind)
    return _blocks[key]


@dataclass(frozen=True)
class Script:
    """How names of a script read. letters: small ones, in tiers: plain, those of many languages, and (by ranges of Unicode) all others with the marks that combine. A word belongs to the first tier that has all its letters. Surrogates are made of syllables; the vowel of the first one is taken from the word's tier. endings: what tells the gender; without one of them a word's last letter does."""

    tiers: tuple[str, str]
    ranges: tuple[tuple[int, int], ...]
    consonants: str
    vowels: tuple[str, str, str]
    endings: tuple[str, ...] = ()

    @cached_property
    def letters(self) -> list[str]:
        plain, more = self.tiers
        every = (chr(i) for a, b in (*self.ranges, (0x300, 0x370)) for i in range(a, b))
        rest = "".join(c for c in every if c not in plain + more and c.lower() == c and unicodedata.category(c)[0] in "LM")
        return [plain, plain + more, plain + more + rest]

    def tier(self, low: str) -> int | None:
        return next((i for i, letters in enumerate(self.letters) if all(c in letters for c in low)), None)

    @cached_property
    def syllables(self) -> list[list[str]]:
        return [[c + v for c in self.consonants for v in vowels] for vowels in self.vowels]


SCRIPTS = [
    Script(("abcdefghijklmnopqrstuvwxyz", "ßàáâãäåæçèéêëìíîïñòóôõöøùúûüýąćčęěğłńőřśşšůűźżž"), ((0xDF, 0x250), (0x1E00, 0x1F00)), "bdfghklmnprstvz", ("aeiou", "áéíóú", "ăĕĭŏŭ")),
    Script(("абвгдежзийклмнопрстуфхцчшщъыьэюяё", "ґєіїўјљњћђџ"), ((0x430, 0x530),), "бвгдзклмнпрст", ("аеиоу", "єіїўё", "ӑӗӣӧӯ"), ("ский", "ская", "ва", "на")),
    Script(("αβγδεζηθικλμνξοπρστυφχψως", "άέήίόύώϊϋΐΰ"), ((0x370, 0x400), (0x1F00, 0x2000)), "βγδκλμνπρστ", ("αεηιο", "άέήίό", "ἀἐἠἰὀ")),
]


#: Places from which strings are permuted without writing them as one number.
LONG = 1024


class Permutation:
    """Keyed permutations of the numbers below any size, each without a fixed point: the allowed numbers are laid in a ring, in an order that a Feistel network over the least even count of bits gives (walked on until a value falls below the size), and each turns into the next one. Each size and kind has its own. Different values never meet, and none but a value without any like stays what it is."""

    ROUNDS = 8

    def __init__(self, key: bytes):
        self.key = key

    def _step(self, kind: bytes, half: int, i: int, x: int) -> int:
        size = (half + 7) // 8
        digest = b""
        while len(digest) < size:
            digest += hashlib.blake2b(bytes((i, len(digest) // 64)) + x.to_bytes(size, "big"), key=self.key, person=kind[:16]).digest()
        return int.from_bytes(digest[:size], "big") & (1 << half) - 1

    def _place(self, name: bytes, size: int, x: int, back: bool = False) -> int:
        """The place of x in the ring, or what stands at place x."""
        half = ((size - 1).bit_length() + 1) // 2
        while True:
            left, right = x >> half, x & (1 << half) - 1
            for i in range(self.ROUNDS):
                if back:
                    left, right = right ^ self._step(name, half, self.ROUNDS - 1 - i, left), left
                else:
                    left, right = right, left ^ self._step(name, half, i, right)
            x = left << half | right
            if x < size:
                return x

    def __call__(self, kind: str, size: int, x: int, allowed: Callable[[int], bool] = lambda x: True) -> int:
        if size < 2:
            return x
        name = hashlib.blake2b(f"{kind}:{size}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        at = self._place(name, size, x)
        while True:
            at = (at + 1) % size
            new = self._place(name, size, at, back=True)
            if allowed(new):
                return new

    def long(self, kind: str, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The like for strings of any length, in time that grows with it: values[i] below sizes[i] to others of such, one to one. A Feistel network gives the ring's order too: each half is shifted, place by place, by a stream that the other half gives. One step along the ring changes the first place that can change."""
        name = hashlib.blake2b(f"{kind}:{len(values)}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        half, sizes, values = len(values) // 2, sizes.astype(np.int64), values.astype(np.int64)
        parts, moduli = [values[:half], values[half:]], [sizes[:half], sizes[half:]]

        def stream(i: int) -> np.ndarray:
            seed = hashlib.blake2b(bytes((i,)) + parts[1 - i % 2].astype("<u4").tobytes(), key=self.key, person=name).digest()
            return (np.frombuffer(hashlib.shake_256(seed).digest(8 * len(parts[i % 2])), "<u8") % moduli[i % 2].astype(np.uint64)).astype(np.int64)

        for i in range(self.ROUNDS):
            parts[i % 2] = (parts[i % 2] + stream(i)) % moduli[i % 2]
        first = np.flatnonzero(sizes > 1)
        if len(first):
            k, at = (0, int(first[0])) if first[0] < half else (1, int(first[0]) - half)
            parts[k] = parts[k].copy()
            parts[k][at] = (parts[k][at] + 1) % moduli[k][at]
        for i in reversed(range(self.ROUNDS)):
            parts[i % 2] = (parts[i % 2] - stream(i)) % moduli[i % 2]
        return np.concatenate(parts)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


class Surrogates:
    """What each kind of entity turns into. A surrogate depends on key and entity alone, so that mentions of one entity stay one (whatever their punctuation or case) and those of two stay two, in all documents and on all workers."""

    def __init__(self, key: bytes):
        self.permute = Permutation(hashlib.blake2b(key, digest_size=32).digest())

    def letters(self, kind: str, text: str, keep: Callable[[int], bool] = lambda i: False, allowed: Callable[[str], bool] | None = None) -> str:
        """text with each letter and digit replaced by one of its class, but at places to keep; all are drawn together from the strings of this pattern that are allowed."""
        places = [(i, a) for i, a in enumerate(map(class_of, text)) if a and not keep(i)]
        if len(places) > LONG:
            return self._long_letters(kind, text, places, allowed)
        size, x = 1, 0
        for i, alphabet in places:
            size *= len(alphabet)
            x = x * len(alphabet) + alphabet.index(text[i])
        out = list(text)
        for i, _ in places:
            out[i] = "*"
        kept = "".join(out)

        def spelled(x: int) -> str:
            for i, alphabet in reversed(places):
                x, at = divmod(x, len(alphabet))
                out[i] = alphabet[at]
            return "".join(out)

        return spelled(self.permute(f"{kind}|{kept}|{','.join(a[0] for _, a in places)}", size, x, (lambda x: allowed(spelled(x))) if allowed else lambda x: True))

    def _long_letters(self, kind: str, text: str, places: list[tuple[int, str]], allowed: Callable[[str], bool] | None) -> str:
        out = list(text)
        for i, _ in places:
            out[i] = "*"
        pattern = hashlib.blake2b(f"{''.join(out)}|{','.join(a[0] for _, a in places)}".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        values, sizes = np.array([a.index(text[i]) for i, a in places]), np.array([len(a) for _, a in places])
        while True:  # on along the ring, as for short ones, until one is allowed
            values = self.permute.long(f"{kind}|{pattern}", values, sizes)
            for (i, a), x in zip(places, values.tolist()):
                out[i] = a[x]
            if allowed is None or allowed("".join(out)):
                return "".join(out)

    def digits(self, kind: str, digits: str, allowed: Callable[[str], bool] = lambda d: True) -> str:
        n = len(digits)
        return f"{self.permute(f'{kind}{n}', 10**n, int(digits or 0), lambda x: allowed(f'{x:0{n}d}')):0{n}d}" if n else digits

    @staticmethod
    def fill(form: str, digits: str) -> str:
        """form with its digits, in turn, replaced."""
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in form)

    def email(self, text: str) -> str:
        low = text.lower() if len(text.lower()) == len(text) else text
        new = self.letters("email", low, lambda i, last=low.rfind("."): i > last)
        return "".join(n.upper() if o.isupper() else n for n, o in zip(new, text))

    def phone(self, text: str) -> str:
        """A country's code stays, and so does the zero that national numbers begin with, and the first of nine digits, which tells mobile from other numbers; others begin with no zero."""
        d = re.sub(r"\D", "", text)
        if text[0] == "+":
            head = 1 if d[0] in "17" else 2
            return self.fill(text, d[:head] + self.digits("phone" + d[:head], d[head:]))
        if d[0] == "0":
            return self.fill(text, "0" + self.digits("phone0", d[1:]))
        if len(d) == 9:
            return self.fill(text, d[0] + self.digits("phone9" + d[0], d[1:]))
        return self.fill(text, self.digits("phone", d, lambda x: x[0] != "0"))

    def ip(self, text: str) -> str:
        if ":" in text:
            base = "0123456789ABCDEF" if text != text.lower() else "0123456789abcdef"
            held = text.replace(":", "")
            form = "".join(c if c == ":" else "*" for c in text)
            new = iter(format(self.permute(f"ip6{form}{base[-1]}", 16 ** len(held), int(held, 16)), f"0{len(held)}{'X' if base[-1] == 'F' else 'x'}"))
            return "".join(c if c == ":" else next(new) for c in text)
        octets = [int(x) for x in text.split(".")]
        common = lambda first: 0 < first < 224
        x = self.permute("ip", 1 << 32, int.from_bytes(bytes(octets), "big"), lambda x: common(x >> 24) == common(octets[0]))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def card(self, text: str) -> str:
        d = re.sub(r"\D", "", text)
        if luhn(d):
            body = d[0] + self.digits("card" + d[0], d[1:-1])
            return self.fill(text, body + next(c for c in "0123456789" if luhn(body + c)))
        return self.fill(text, d[0] + self.digits("number" + d[0], d[1:], lambda x: not luhn(d[0] + x)))

    def ssn(self, text: str) -> str:
        return self.fill(text, self.digits("ssn", re.sub(r"\D", "", text)))

    def iban(self, text: str) -> str:
        if text[0].islower():
            return self.iban(text.upper()).lower()
        bare = text.replace(" ", "")
        rest = self.letters("iban" + bare[:2], bare[4:])
        it = iter(bare[:2] + iban_check(bare[:2], rest) + rest)
        return "".join(c if c == " " else next(it) for c in text)

    def secret(self, text: str) -> str:
        """Hex digits give hex digits; those without a letter none, others some, so that no form turns into another. Other secrets keep their pattern and never read as hex."""
        n = len(text)
        for base in ("0123456789", "0123456789abcdef", "0123456789ABCDEF"):
            if not set(text) - set(base):
                if n > LONG:
                    values = np.array([base.index(c) for c in text])
                    while True:
                        values = self.permute.long(base, values, np.full(n, len(base)))
                        new = "".join(base[x] for x in values.tolist())
                        if len(base) == 10 or not new.isdigit():
                            return new
                if len(base) == 10:
                    return self.digits("secret", text)
                form = f"0{n}{'x' if base[-1] == 'f' else 'X'}"
                return format(self.permute(base + str(n), 16**n, int(text, 16), lambda x: not format(x, form).isdigit()), form)
        return self.letters("secret", text, allowed=lambda s: not _HEX.fullmatch(s))

    def name(self, word: str) -> str:
        """Listed given names change places within their gender and script. Other words of Latin, Cyrillic or Greek letters become words of syllables, with the same ending, which in many languages tells the gender; words of other scripts change letters one by one. Parts at apostrophes change each for itself; initials change their letter. No surrogate but a given name's is a listed one."""
        if word.lower() in GENDERS:
            key = GENDERS[word.lower()]
            names = GIVEN[key]
            new = names[self.permute("given" + "".join(key), len(names), [n.lower() for n in names].index(word.lower()))]
            return new.upper() if word.isupper() else new
        if _APOSTROPHE.search(word):
            return "".join(self.name(x) if x and not _APOSTROPHE.fullmatch(x) else x for x in _APOSTROPHE.split(word))
        low = word.lower()
        script = next((s for s in SCRIPTS if s.tier(low) is not None), None)
        if script is None or len(low) < 2:
            return self.letters("name", word)
        new = self._syllables(script, low)
        return new.upper() if word.isupper() else new[0].upper() + new[1:] if word[0].isupper() else new

    def _syllables(self, script: Script, low: str) -> str:
        """The words of a tier and ending are numbered by length, then letters; so are those of two syllables or more, from the first numbers on, but for listed names. A word's number, permuted among those with as many syllables, is the surrogate's. So each word has one, different words have different ones, and no word its own: there are far more letters than syllables, so that a word that reads like a surrogate of k syllables turns into one of more."""
        tier = script.tier(low)
        letters, first, other = script.letters[tier], script.syllables[tier], script.syllables[0]
        end = next((e for e in script.endings if low.endswith(e) and len(e) < len(low)), low[-1])
        x, k = 0, 1
        for c in low[: -len(end)]:
            x = x * len(letters) + letters.index(c) + 1
        while True:
            k += 1
            listed = sorted(self._numbers(first, other, end, k)) if not tier else []
            size = len(first) * len(other) ** (k - 1) - len(listed)
            if x < size:
                break
            x -= size
        x = self.permute(f"name{k}{letters[0]}{tier}{end}", size, x)
        for taken in listed:
            x += x >= taken
        out = []
        for _ in range(k - 1):
            x, at = divmod(x, len(other))
            out.append(other[at])
        return "".join([first[x], *reversed(out), end])

    @staticmethod
    @lru_cache(100_000)
    def _listed(end: str, k: int) -> tuple[str, ...]:
        return tuple(n for n in GENDERS if n.endswith(end) and len(n) == 2 * k + len(end))

    def _numbers(self, first: list[str], other: list[str], end: str, k: int) -> Iterator[int]:
        """The numbers of those listed names that read like a surrogate of k syllables."""
        for name in self._listed(end, k):
            parts = [name[i : i + 2] for i in range(0, 2 * k, 2)]
            if parts[0] in first and all(p in other for p in parts[1:]):
                x = first.index(parts[0])
                for p in parts[1:]:
                    x = x * len(other) + other.index(p)
                yield x


_HEX = re.compile("[0-9a-f]+|[0-9A-F]+")
_RUN = re.compile(r"\w+")
_APOSTROPHE = re.compile("(['’])")
#: What stands before a secret's value, which ends with its quote or, without one, at white space.
_SECRET = r"\b(?:api[_-]?key|access[_-]?key|secret|token|passw(?:or)?d|pwd)\b[\"']?\s{0,3}[:=]\s{0,3}"
_HEXTETS = re.compile("[0-9A-Fa-f]{1,4}")


def _is_secret(value: str) -> bool:
    return len(value) >= 8 and any(c.isdigit() for c in value)


def _is_ip6(value: str) -> bool:
    """An address with three groups or more, and a digit among them, so that no word at colons is one."""
    parts = _HEXTETS.findall(value)
    if len(parts) < 3 or not any(c.isdigit() for c in value):
        return False
    try:
        return ip_address(value).version == 6
    except ValueError:
        return False


PATTERNS: list[tuple[str, re.Pattern, int, Callable[[str], bool]]] = [
    ("secret", re.compile(rf"(?i){_SECRET}\"([^\"\n]+)\""), 1, _is_secret),
    ("secret", re.compile(rf"(?i){_SECRET}'([^'\n]+)'"), 1, _is_secret),
    ("secret", re.compile(rf"(?i){_SECRET}([^\s\"']*[^\s\"'.,;:!?)\]}}>])"), 1, _is_secret),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16})(?![A-Za-z0-9])"), 0, lambda s: not s.isdigit()),
    ("iban", re.compile(r"\b(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)\b"), 0, lambda s: iban_check(s[:2], s.replace(" ", "")[4:]) == s[2:4]),
    ("ip", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?:[0-9A-Fa-f]{1,4}:){2,7}:|::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){2,6})(?![\w:]|\.\d)"), 0, _is_ip6),
    ("ip", re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"), 0, lambda s: all(int(x) < 256 and str(int(x)) == x for x in s.split("."))),
    ("card", re.compile(r"(?<![\d+-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\d]|-\d)"), 0, lambda s: len(re.sub(r"\D", "", s)) == 16 or luhn(re.sub(r"\D", "", s))),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), 0, lambda s: True),
    ("phone", re.compile(r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d.+-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)"), 0, lambda s: 8 <= len(re.sub(r"\D", "", s)) <= 15),
    # national forms: of French (01 23 45 67 89), German ((030) 123456, 0171/1234567) and Spanish (612 345 678, 91 123 45 67) numbers
    ("phone", re.compile(r"(?<![\w.,+-])(?:0[1-9](?:[ .-]?\d{2}){4}|\(0\d{2,4}\)[ /-]?\d{3,5}(?:[ -]?\d{2,5}){0,2}|0\d{2,4}[ /-]\d{3,5}(?:[ -]?\d{2,5}){0,2}|[679]\d{2} \d{3} \d{3}|[679]\d{2}(?: \d{2}){3}|9\d \d{3} \d{2} \d{2})(?![\w-]|[.,]\d| \d)"), 0, lambda s: 8 <= len(re.sub(r"\D", "", s)) <= 13),
]
#: Read backwards from the @; and forwards.
_LOCAL, _DOMAIN = re.compile(r"[\w.+%-]*"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_GAP = r"[ \t\xa0]"
#: A run of titles, with the degrees and faculties that may follow them.
_TITLED = re.compile(rf"(?i)\b(?:{_TITLE})\b(?:\.?{_GAP}+|\.|\.?-)(?:(?:{_TITLE}|med|phil|jur|ing|rer|nat|pol|habil|h\.{_GAP}?c)\b(?:\.{_GAP}*|{_GAP}+|\.?-))*")
_LETTER = "(?:[^\\W\\d_]|[̀-ͯ])"
#: A word of a name, with apostrophes inside (O'Brien, D'Angelo) but not those of the genitive; parts at hyphens are words of their own.
_WORD = re.compile(rf"[^\W\d_](?:['’]{_LETTER}{{2,}}|{_LETTER}+(?:['’](?=[^\W\d_a-z]){_LETTER}+)*)?")
_BETWEEN = re.compile(rf"{_GAP}+|\.{_GAP}*|[-‐‑]")
_PARTICLE = re.compile(rf"(?:(?:van|von|vom|zu|zum|zur|und|de|del|della|der|den|des|di|da|das|dos|du|la|las|le|los|el|al|ibn|bin|af|av|ter|ten|te){_GAP}+|al-|d['’])+(?=[^\W\d_])")
_TITLE_HINT = re.compile(_TITLE, re.I)
_GIVEN = re.compile(r"(?<!\w)(?:" + "|".join(sorted({x for names in GIVEN.values() for n in names for x in (n, n.upper())}, key=len, reverse=True)) + r")(?!\w)")
#: What ends a name although it may be capitalised, as in headings.
_STOPS = {w for words in COMMON_WORDS.values() for w in words}


def name_words(text: str, at: int) -> list[tuple[int, int]]:
    """(start, end) of the words of the name that begins at a place: all capitalised words in a row (or in scripts without capitals), with initials, hyphens, apostrophes, and particles between. A title, a common word other than at its start, any other sign or the end of the line ends it."""
    out: list[tuple[int, int]] = []
    while True:
        particle = _PARTICLE.match(text, at)
        if particle and not text[particle.end()].islower():
            at = particle.end()
        word = _WORD.match(text, at)
        if not word or word[0][0].islower() or word[0].lower() in TITLES or out and len(word[0]) > 1 and word[0].lower() in _STOPS and not _PARTICLE.match(word[0].lower() + " x"):
            return out
        out.append(word.span())
        between = _BETWEEN.match(text, word.end())
        if not between or between[0][0] == "." and len(word[0]) > 1:
            return out
        at = between.end()


def _again(text: str, words: set[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of all mentions of words of two letters or more in a text, the longest where several begin at a place: one walk, whatever their number."""
    sizes: dict[str, set[int]] = {}
    for word in words:
        if len(word) > 1:
            sizes.setdefault(_RUN.match(word)[0], set()).add(len(word))
    longest = {first: sorted(n, reverse=True) for first, n in sizes.items()}
    reached = 0
    for run in _RUN.finditer(text):
        at = run.start()
        for n in longest.get(run[0], ()) if at >= reached else ():
            if text[at : at + n] in words and not _RUN.match(text, at + n):
                yield at, at + n
                reached = at + n
                break


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a whole text, in order, without overlaps; of overlapping ones the kind listed first counts. A name begins after a title or with a listed given name (name_words() says how far it goes); its words, but for initials, are found again wherever they stand in the text, spelled alike."""
    found: list[tuple[int, int, str]] = []
    before, at = 0, text.find("@")
    while at >= 0:
        right = _DOMAIN.match(text, at + 1)
        if right:
            local = _LOCAL.match(text[before:at][::-1])[0][::-1].lstrip(".-%+")
            if local:
                found.append((at - len(local), right.end(), "email"))
        before, at = at + 1, text.find("@", at + 1)
    if any(d in text for d in "0123456789"):
        for kind, pattern, group, fits in PATTERNS:
            found += [(*m.span(group), kind) for m in pattern.finditer(text) if fits(m[group])]
    starts = [m.end() for m in _TITLED.finditer(text)] if _TITLE_HINT.search(text) else []
    spans, reached = set(), 0
    for at in sorted([*starts, *(m.start() for m in _GIVEN.finditer(text))]):
        if at >= reached:  # else inside a name that is known
            name = name_words(text, at)
            spans.update(name)
            reached = name[-1][1] if name else reached
    if spans:
        spans.update(_again(text, {text[a:b] for a, b in spans}))
        found += [(a, b, "name") for a, b in sorted(spans)]
    out, end = [], 0
    taken: list[tuple[int, int, str, int]] = []
    for i, (a, b, kind) in sorted(enumerate(found), key=lambda x: (x[1][0], x[0])):
        if a >= end:
            taken.append((a, b, kind, i))
            end = b
        elif taken and i < taken[-1][3] and a < taken[-1][1]:
            taken[-1] = (a, b, kind, i)
            end = b
    for span in taken:
        if not out or span[0] >= out[-1][1]:
            out.append(span[:3])
    return out


SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("kind", pa.string()), ("surrogate", pa.string()), ("original_hash", pa.string())])


def replace(docs: DataFrame, *, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, text (with surrogates), spans: start and length in the old text, kind, surrogate, original_hash (keyed) of each entity.

    Kinds: email, phone, ip, card, ssn, iban, secret, name (after a title or with a listed given name). Entities of the open-ended kinds (email, secret, name) go whole, whatever their length. A surrogate keeps kind and form: punctuation, letter case, script, vowels and consonants, country codes, card type, check digits, hex digits; given names their gender; names become names, of syllables and with the same ending, which are longer or shorter than they. It comes from a keyed permutation of all entities of that form (format-preserving encryption) that leaves none as it is, so that equal entities stay equal and different ones different over the whole corpus, with no table of entities and no shuffle; with_collisions() checks this on the spans. original_hash is the same for names that differ in case alone.

    Null text stays null, with no spans. Empty and entity-free texts stay as they are. Rows are treated one by one, with null and repeated ids passed through. An empty table gives no rows. Columns besides the two are not read.
    """
    ready(docs.sparkSession)
    kind_of_id = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Surrogates(key)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, spans, size = [], [], 0
                for value in batch.column(1)[at:]:
                    text = value.as_py()
                    size += len(text or "")
                    parts, rows, before = [], [], 0
                    for a, b, kind in find(text or ""):
                        new = getattr(make, kind)(text[a:b])
                        parts += [text[before:a], new]
                        before = b
                        same = text[a:b].lower() if kind == "name" else text[a:b]
                        original = hashlib.blake2b(same.encode(), key=make.permute.key, digest_size=16).hexdigest()
                        rows.append({"start": a, "length": b - a, "kind": kind, "surrogate": new, "original_hash": original})
                    texts.append(text if text is None or not rows else "".join([*parts, text[before:]]))
                    spans.append(rows)
                    if size >= 4 << 20 or len(texts) >= 4096:
                        break
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + len(texts)], pa.array(texts, pa.string()), pa.array(spans, pa.list_(SPAN))], ["doc_id", "text", "spans"])
                at += len(texts)

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = rows.mapInArrow(lean(run), f"doc_id {kind_of_id}, text string, spans array<struct<start:long,length:long,kind:string,surrogate:string,original_hash:string>>")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def collisions(replaced: DataFrame) -> DataFrame:
    """(kind, surrogate, originals): surrogates that stand for more than one original. No row is to be expected. Names count without their case."""
    spans = replaced.select(F.explode("spans").alias("s")).select("s.*")
    low = F.when(F.col("kind") == "name", F.lower("surrogate")).otherwise(F.col("surrogate"))
    sums = spans.groupBy("kind", low.alias("surrogate")).agg(F.min("original_hash").alias("lo"), F.max("original_hash").alias("hi"))
    shared = sums.where("lo < hi").select("kind", "surrogate")
    again = spans.withColumn("surrogate", low).join(shared, ["kind", "surrogate"])
    return again.groupBy("kind", "surrogate").agg(F.countDistinct("original_hash").alias("originals"))


def with_collisions(replaced: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """replaced, a written table, with n_collisions (long): how many entities of the rows of an id got a surrogate that stands for another original too, anywhere in the table. Spans alone are grouped; where no collision is found, as is to be expected, no text is moved."""
    shared = collisions(replaced)
    if shared.isEmpty():
        return replaced.withColumn("n_collisions", F.lit(0).cast("long"))
    key, n = unused(replaced, "c_id", "n_collisions")
    spans = replaced.select(F.col(f"`{id_col}`").alias(key), F.explode("spans").alias("s")).select(key, "s.kind", F.when(F.col("s.kind") == "name", F.lower("s.surrogate")).otherwise(F.col("s.surrogate")).alias("surrogate"))
    counts = spans.join(shared, ["kind", "surrogate"]).groupBy(key).agg(F.count("*").alias(n))
    return replaced.join(counts, F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left").select(*replaced.columns, F.coalesce(n, F.lit(0)).cast("long").alias("n_collisions"))
