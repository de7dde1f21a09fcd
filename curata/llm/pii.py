"""Personal information in free text: find it, and replace it with typed placeholders.

Anchor expansion: one Aho-Corasick pass over a text finds at-signs, schemes, digits, street words,
and the cues of numbers and names. Around each anchor a deterministic local parser expands and
validates an e-mail address, a phone number, an identity number, a street address or a person's
name. Parsers are bounded by their grammar, not by a window: a value of any length is read whole.
What only looks alike (orders, lots, catalogue numbers, accessions, trials, firms, places) fails
the parser or has a cue that speaks against it.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "street_address", "id_number", "phone", "person_name"]  # the first of overlapping kinds holds

#: White space within a value, also where a quoted line is wrapped.
GAP = r"(?:[^\S\n]+|[^\S\n]*\n[>\s]*)"


class Span(NamedTuple):
    kind: str
    start: int
    end: int


# E-mail addresses -------------------------------------------------------------------------------

# Words are matched whole (atomic groups), so a text that fits no address is left after one reading.
LABEL = r"(?>[^\W_][\w-]*)(?<=[^\W_])"
LOCAL = r"(?>[^\W_][\w+.-]*)(?<=\w)"
DOT = r"(?:\.|\s*[\[({]\s*dot\s*[\])}]\s*)"
SPELLED_DOT = rf"(?:{DOT}|\s+dot\s+)"
EMAILS = {
    "@": re.compile(rf"(?P<local>{LOCAL}(?:{SPELLED_DOT}{LOCAL})*)\s?@\s?(?P<domain>{LABEL}(?:{DOT}{LABEL})*{DOT}[^\W\d_]{{2,}})(?![\w-])", re.I),
    "bracket": re.compile(rf"(?P<local>{LOCAL}(?:{SPELLED_DOT}{LOCAL})*)\s*[\[({{]\s*at\s*[\])}}]\s*(?P<domain>{LABEL}(?:{SPELLED_DOT}{LABEL})*{SPELLED_DOT}[^\W\d_]{{2,}})(?![\w-])", re.I),
    "word": re.compile(rf"(?P<local>{LOCAL}(?:\s+dot\s+{LOCAL})*)\s+at\s+(?P<domain>{LABEL}(?:{SPELLED_DOT}{LABEL})*\s+dot\s+[^\W\d_]{{2,}})(?![\w-])(?!\s+(?:at|dot)\s)(?![^\S\n]*[\[({{@])", re.I),
}
#: A spelled dot right before a word; blanks around it are few.
DOT_BEFORE = re.compile(r"\s{1,6}dot\s{1,6}\Z", re.I)


def email_at(text: str, at: int, form: str) -> Span | None:
    """The address around the at-sign (or its spelling) at position ``at``."""
    left = at
    while left and text[left - 1].isspace():
        left -= 1
    # The local part: words joined by a spelled dot, or the characters up to a blank or bracket.
    begin = left
    while True:
        while begin and not (text[begin - 1].isspace() or text[begin - 1] in "<>\"',;:|()[]@"):
            begin -= 1
        joined = DOT_BEFORE.search(text, max(0, begin - 16), begin) if begin < left else None
        if not joined:
            break
        begin = joined.start()
    if begin == left:
        return None
    word = text[begin:left]
    begin += len(word) - len(word.lstrip("+.-_/="))
    for start in [begin] + [begin + x.end() for x in re.finditer(r"\s+dot\s+|[^\w.+-]", text[begin:left], re.I)]:
        found = EMAILS[form].match(text, start)
        if found and found.end("local") <= at < found.start("domain"):
            return Span("email", found.start(), found.end())
    return None


# Street addresses -------------------------------------------------------------------------------

# Words for streets.
STREETS_AFTER = ["street", "st", "avenue", "ave", "road", "rd", "lane", "ln", "way", "court", "ct", "drive", "dr", "close", "crescent", "terrace", "square", "boulevard", "blvd", "place", "gardens", "parkway", "pkwy", "highway", "hwy", "mews", "esplanade", "quay"]
STREETS_FRENCH = ["rue", "avenue", "boulevard", "place", "chemin", "quai", "allée", "impasse", "cours", "route"]
STREETS_SPANISH = ["calle", "avenida", "avda.", "plaza", "paseo", "camino", "c/"]
STREETS_ITALIAN = ["via", "viale", "piazza", "corso", "largo", "vicolo", "rua", "travessa", "ulica", "ul.", "aleja", "al."]
STREETS_GERMAN = ["straße", "strasse", "str.", "weg", "platz", "gasse", "allee", "ring", "ufer", "damm", "straat", "laan", "plein", "gracht", "gatan", "vägen"]
BOXES = ["box", "postfach", "apartado", "boîte postale"]

CAPITAL = r"[^\W\d_a-zß-öø-ÿ][\w’'-]*"
NAMED = rf"{CAPITAL}(?:{GAP}{CAPITAL}){{0,2}}"
CITY = rf"{CAPITAL}(?:{GAP}{CAPITAL}){{0,2}}"
#: Postcodes: with letters (British, Canadian, Dutch), with a hyphen, or four to nine digits.
POST = rf"(?:[A-Z]{{1,2}}\d[A-Z\d]?{GAP}?\d[A-Z]{{2}}|[A-Z]\d[A-Z]{GAP}?\d[A-Z]\d|\d{{4}}{GAP}[A-Z]{{2}}(?!\w)|\d{{2}}-\d{{3}}|\d{{5}}-\d{{4}}|\d{{4,5}})"
TOWN = rf"(?:,{GAP}?|{GAP})(?:{POST}{GAP}{CITY}|{CITY}(?:,{GAP}[A-Z]{{2}})?,?{GAP}{POST})(?![\w])|,{GAP}{CAPITAL}"
FLAT = rf"(?:,{GAP}(?i:flat|apt\.?|apartment|unit|suite|floor){GAP}\w+)?"


def _any(words: list[str]) -> str:
    return "(?i:" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + ")"


ADDRESSES = [
    re.compile(rf"(?:(?i:flat|apt\.?|apartment|unit|suite){GAP}\w+,{GAP})?\d{{1,5}}[A-Za-z]?,?{GAP}{NAMED}{GAP}{_any(STREETS_AFTER)}\b\.?{FLAT}(?:{TOWN})?"),
    re.compile(rf"\d{{1,5}}(?:{GAP}(?i:bis|ter|quater))?,?{GAP}{_any(STREETS_FRENCH)}{GAP}(?:(?i:de|du|des|de la|de l'|d'){GAP}?)?{CAPITAL}(?:{TOWN})?"),
    re.compile(rf"(?<!\w){_any(STREETS_SPANISH)}{GAP}(?:(?i:de|del|de la|de los){GAP})?{NAMED},?{GAP}\d{{1,5}}[A-Za-z]?(?:,{GAP}\d+\.?[ºª°]{GAP}?\w)?(?:{TOWN})?"),
    re.compile(rf"(?<!\w){_any(STREETS_ITALIAN)}{GAP}{NAMED},?{GAP}\d{{1,5}}[A-Za-z]?(?:{TOWN})?"),
    re.compile(rf"(?<!\w)[^\W\d_a-zß-öø-ÿ][\w-]*?{_any(STREETS_GERMAN)}{GAP}\d{{1,5}}[A-Za-z]?(?!\w)(?:{TOWN})?"),
    re.compile(rf"(?<!\w)(?i:p\.?{GAP}?o\.?{GAP}?box|post(?:fach| office box)|apartado|boîte postale){GAP}\d{{2,7}}(?:{TOWN})?"),
]


#: Patterns of ADDRESSES by the kind of their street word, and what must stand beside the word.
FAMILIES = [(STREETS_AFTER, 0), (STREETS_FRENCH, 1), (STREETS_SPANISH, 2), (STREETS_ITALIAN, 3), (STREETS_GERMAN, 4), (BOXES, 5)]
AHEAD = re.compile(rf"{GAP}\d")
LEFT_TOKENS = 8  # flat and its number, house number, three words of a name and what joins them


def address_at(text: str, at: int, size: int, family: int) -> Span | None:
    """The address of one family whose street word stands at position ``at``."""
    stop = at + size
    if family != 4 and at and text[at - 1].isalnum():
        return None
    if family in (0, 1, 5) and stop < len(text) and text[stop].isalnum():
        return None
    if family == 4 and not AHEAD.match(text, stop):
        return None
    starts, digit = [at], family not in (0, 1)
    if family == 4:
        while starts[0] and (text[starts[0] - 1].isalnum() or text[starts[0] - 1] == "-"):
            starts[0] -= 1
    first = starts[0]
    for _ in range(LEFT_TOKENS if family in (0, 1) else 2 if family == 5 else 0):
        while first and text[first - 1].isspace():
            first -= 1
        while first and not text[first - 1].isspace():
            first -= 1
            digit = digit or text[first].isdigit()
        while first < at and not text[first].isalnum():
            first += 1
        starts.append(first)
    if not digit:
        return None
    for start in reversed(starts):
        if start and text[start - 1].isalnum():
            continue
        m = ADDRESSES[family].match(text, start)
        if m and m.end() > at:
            return Span("street_address", m.start(), m.end())
    return None


# Numbers ----------------------------------------------------------------------------------------

NUMBERISH = re.compile(r"(?<![\w.])[+(]{0,2}\d(?:[\d().\-/–]|[^\S\n](?=[\d(\-–])|(?<=\d)\n>?[^\S\n]?(?=\d)){4,60}\d(?:-[A-Z](?!\w))?|(?<![\w-])[A-Z]{1,2}[- ]?\d[\dA-Z .-]{5,60}")  # no number is longer
BEFORE_DIGIT = re.compile(r"(?:[+(]{0,2}|[A-Z]{1,2}[- ]?)\Z")

IDENTITY = [
    re.compile(r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]"),  # two letters, six digits, one letter
    re.compile(r"[A-Z]{2}\d{2}[A-Z]\d{5}"),
    re.compile(r"[A-Z]\d{8}"),
    re.compile(r"[A-Z]{2}-\d{4}-\d{4}-\d{2}"),
    re.compile(r"\d{2}\.\d{3}\.\d{3}-[A-Z]"),
    re.compile(r"\d{8}-?[A-Z]"),
    re.compile(r"(?:000|666|9\d\d)[- ]\d{2}[- ]\d{4}"),
    re.compile(r"\d \d{2} \d{2} \d{2} \d{3} \d{3}(?: \d{2})?"),
    re.compile(r"\d{2} \d{3} \d{3} \d{3}"),
    re.compile(r"\d{3} \d{3} \d{3} \d{2}"),
    re.compile(r"999[ -]?\d{3}[ -]?\d{4}"),
]
LOOSE_IDENTITY = re.compile(r"[A-Z]{0,3}[- ]?\d[\dA-Z]*(?:[ .\-/][\dA-Z]+)*")
EXTENSION = re.compile(r"\s*(?:ext\.?|x|extension|Durchwahl|poste)\s*\d{1,5}", re.I)
PHONES = [
    re.compile(r"\+\d{1,3}(?:[ .\-/]?\(?\d+\)?)+"),
    re.compile(r"00[1-9]\d{0,2}(?:[ .\-/]\(?\d+\)?){2,5}"),
    re.compile(r"\(\d{2,5}\) ?\d{3,4}[ .-]?\d{3,4}"),
    re.compile(r"1[-. ]\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}"),
    re.compile(r"[2-9]\d{2}[-. ]\d{3}[-. ]\d{4}"),
    re.compile(r"[2-9]\d{2}-\d{4}"),
    re.compile(r"\d \d \d [-–] \d \d \d \d"),
    re.compile(r"0\d{2} \d{4} \d{4}"),
    re.compile(r"0[1-9]\d{2,3} ?\d{3} ?\d{3,4}"),
    re.compile(r"0[1-9]\d{1,4}/\d{4,9}"),
    re.compile(r"0[1-9](?:[. -]\d{2}){4}"),
]
LOOSE_PHONE = re.compile(r"(?!\d{4}-\d\d-\d\d|\d{1,2}\.\d{1,2}\.\d{4})[+(]{0,2}\d[\d ().\-/–]*\d")



def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def is_social_security(value: str) -> bool:
    """Area, group and serial as issued: no zero part, no area 666; areas from 900 on are tax numbers."""
    area, group, serial = value[:3], value[4:6], value[7:]
    return area not in ("000", "666") and group != "00" and serial != "0000"


def is_health_number(value: str) -> bool:
    """Ten digits of which the last is the check digit modulo 11."""
    d = _digits(value)
    check = 11 - sum(x * w for x, w in zip(d, range(10, 1, -1))) % 11
    return value[0] in "4679" and (0 if check == 11 else check) == d[9]


def is_account(value: str) -> bool:
    """An IBAN: 1 modulo 97 with its first four characters moved to the end."""
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def is_foreigner_number(value: str) -> bool:
    """X, Y or Z, seven digits and the letter of their remainder modulo 23."""
    plain = value.replace("-", "")
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(f"{'XYZ'.index(plain[0])}{plain[1:8]}") % 23] == plain[8]


def is_insured_number(value: str) -> bool:
    """Thirteen digits and their complement modulo 97 as two more."""
    d = "".join(c for c in value if c.isdigit())
    return 97 - int(d[:13]) % 97 == int(d[13:])


def is_card(value: str) -> bool:
    """Sixteen digits with a Luhn check digit."""
    d = _digits(value)
    return sum(x if k % 2 else x * 2 - 9 * (x > 4) for k, x in enumerate(d)) % 10 == 0


#: Numbers that are known by their check digits or issued ranges, without any cue.
CHECKED = [
    (re.compile(r"\d{3}-\d{2}-\d{4}"), is_social_security),
    (re.compile(r"\d{3} \d{3} \d{4}"), is_health_number),
    (re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){2,7}(?: ?[A-Z\d]{1,3})?"), is_account),
    (re.compile(r"[XYZ]-?\d{7}-?[A-Z]"), is_foreigner_number),
    (re.compile(r"[12]\d{14}"), is_insured_number),
    (re.compile(r"\d{4} \d{4} \d{4} \d{4}|\d{16}"), is_card),
]

# What may stand before a number. A cue with a tail may be followed by other words up to a colon.
PHONE_CUES = ["phone", "tel", "tél", "telephone", "teléfono", "telefon", "mobile", "mobil", "handy", "fax", "called from", "number is", "whatsapp", "tel:", "callto:", "t"]
IDENTITY_CUES = ["passport", "dni", "nie", "nif", "ssn", "social security", "insurance no", "insurance number", "sécurité sociale", "ausweisnummer", "identity card", "bears number", "card reads", "id", "nhs number", "national id", "pesel", "tax id", "steuer-id", "cpf", "iban", "account"]
OTHER_NUMBERS = ["catalogue", "catalog", "cat.", "order", "lot", "lote", "probe", "bestellung", "commande", "pedido", "accession", "trial", "pmid", "doi", "version", "rows", "row", "records", "batch", "serial", "panel", "invoice", "item", "protocol"]
TAILED = {"teléfono": r"[^:\n]{0,20}", "ausweisnummer": r"[^:\n]{0,24}"}
SO = rf"{GAP}?(?:no|nr|number|nº|n°|num)?{GAP}?[.:#]?{GAP}?"
BETWEEN = re.compile(r"\W{0,4}" + SO, re.I)
BETWEEN_IDENTITY = re.compile(rf"(?:{GAP}(?:on file|on record|is|was|reads))?\W{{0,4}}{SO}", re.I)
BETWEEN_TAILED = {c: re.compile(t + r"\W{0,4}" + SO, re.I) for c, t in TAILED.items()}


def number_at(text: str, start: int, end: int, is_phone: bool, is_identity: bool) -> Span | None:
    """The phone or identity number in a run of digits and separators, if it is one."""
    run = re.sub(r"\n>?[^\S\n]?", " ", text[start:end]) if "\n" in text[start:end] else text[start:end]
    if run.startswith("(") and not re.match(r"\(+\d{1,5}\)", run):
        opening = len(run) - len(run.lstrip("("))
        start, run = start + opening, run[opening:]
    shift = end - start - len(run)

    def ends(n: int) -> bool:
        return not re.match(r"[\w]|[-./]\d| \d", run[n:] + text[end : end + 2])

    def first(patterns: list[re.Pattern[str]]) -> int:
        longest = 0
        for p in patterns:
            m = p.match(run)
            if m and m.end() > longest and ends(m.end()):
                longest = m.end()
        return longest

    def digits(n: int) -> int:
        return sum(c.isdigit() for c in run[:n])

    checked = 0
    for p, valid in CHECKED:
        m = p.match(run)
        if m and m.end() > checked and ends(m.end()) and valid(m.group()):
            checked = m.end()
    identity = max(checked, first(IDENTITY)) or (is_identity and first([LOOSE_IDENTITY])) or 0
    phone = first(PHONES) or (is_phone and first([LOOSE_PHONE])) or 0
    if phone and not 7 <= digits(phone) <= 15:
        phone = 0
    if identity and digits(identity) < 6:
        identity = 0
    if identity and phone:
        identity, phone = (0, phone) if is_phone and not is_identity or not is_identity and run[0] in "+(" else (identity, 0)
    if identity:
        return Span("id_number", start, start + identity + shift)
    if phone:
        stop = start + phone + shift
        extension = EXTENSION.match(text, stop)
        return Span("phone", start, extension.end() if extension else stop)
    return None


# Names ------------------------------------------------------------------------------------------

# Titles, particles and the phrases around names.
TITLES = ["mr", "mrs", "ms", "miss", "dr", "prof", "professor", "sir", "herr", "frau", "mme", "mlle", "monsieur", "madame", "sr", "sra", "srta", "dra", "don", "doña"]
PARTICLES = ["van", "von", "de", "del", "della", "di", "da", "al", "el", "der", "den", "la", "le", "du", "dos", "bin", "ben", "ter", "ten", "zu"]

#: A word of a name; small words that join or follow names are none.
WORD_ANY = r"(?!(?:and|und|et|y|or|about|at|bears|for|on|called|confirmed)\b)[^\W\d_](?:[^\W\d_]|[’'](?=[^\W\d_]))+(?:-[^\W\d_](?:[^\W\d_]|[’'])+)*"
WORD_CAPITAL = rf"(?=[^\W\d_a-zß-öø-ÿ]){WORD_ANY}"
INITIALS = r"(?:[^\W\d_a-z]\.[- ]?)+"


def _name(word: str) -> str:
    particle = r"(?:(?i:" + "|".join(PARTICLES) + rf"){GAP}){{1,2}}"
    last = rf"(?:{particle})?{word}"
    comma = rf"{last},{GAP}{word}(?:{GAP}{INITIALS})?"
    initials_after = rf"{last}{GAP}[A-ZÀ-Þ]{{1,3}}(?![\w.])"
    initials_before = rf"{INITIALS}{GAP}?{last}"
    full = rf"{word}(?:{GAP}{INITIALS}|{GAP}{word}(?={GAP}))?{GAP}{last}"
    return rf"(?:{comma}|{initials_after}|{initials_before}|{full}|{word})"


TITLED = r"(?:(?i:" + "|".join(TITLES) + rf")\.?{GAP})*"
NAME_ANY, NAME_CAPITAL = rf"{TITLED}(?P<name>{_name(WORD_ANY)})", rf"{TITLED}(?P<name>{_name(WORD_CAPITAL)})"

#: Phrases before and after a name. A name between both may be written in any letter case.
FRAMES = [
    ("corresponding author", r"corresponding author\s*:\s*", r"\s*(?:[.;,(<]|$|\n)"),
    ("collected by", r"collected by ", r" and | on |[.,;]"),
    ("consent form of", r"consent form of ", r" bears "),
    ("questions to", r"questions to ", r" at |[.,;(<]"),
    ("could you ask", r"could you (?:please )?ask ", r" about | to | whether |\?"),
    ("key holder is", r"key holder is ", r"\s*[(.,;]"),
    ("checked with", r"checked with ", r" and |\s*[;.,]"),
    ("minutes by", r"minutes by ", r"\s*[.,;\n]|$"),
    ("according to", r"according to ", r", "),
    ("the donor,", r"the donor, ", r", lives"),
    ("contact", r"contact(?: :|:)? ", r", ?(?:phone|tél|tel)"),
    ("patient", r"patient ", r", ?id"),
    ("from:", r"from: ?", r"\s*[<\n]"),
    ("rückfragen bitte an", r"rückfragen bitte an ", r", ?tel|[.(]"),
    ("ansprechpartner", r"ansprechpartner(?:in)? ist ", r"\s*[(.,]"),
    ("geprüft von", r"geprüft von ", r"\s*[.,;(]|$"),
    ("relu par", r"relu par ", r"\s*[.,;(]|$"),
    ("revisado por", r"revisado por (?:el |la )?", r"\s*[.,;(]|$"),
    ("preguntas a", r"preguntas a ", r"\s*[.(]"),
    ("-- \n", r"(?<!\S)-- \n[>\s]*", r"\s*\n"),
    ("dr.", r"dr\. ", r" confirmed "),
    ("mrs", r"mrs ", r" called "),
    ("mr", r"mr ", r" called "),
]
LISTS = [
    ("present:", r"present\s*:\s*", r"\s*,\s*|\s*;\s*"),
    ("checked with", r"checked with ", r" and "),
]
SIGNATURES = ["thanks,", "thank you,", "best wishes,", "best regards,", "kind regards,", "cheers,", "viele grüße,", "mit freundlichen grüßen,", "cordialement,", "saludos,"]
_SPACE = re.compile(r"(?<!\\) ")


def _loose(pattern: str) -> str:
    """The pattern with every blank standing for any white space, wrapped lines included."""
    return _SPACE.sub(lambda _: GAP, pattern)


FRAMED = {
    cue: (re.compile(f"(?i:{_loose(left)})" + NAME_ANY + f"(?=(?i:{_loose(right)}))"), re.compile(f"(?i:{_loose(left)})" + NAME_CAPITAL + r"(?![\w:/@])"))
    for cue, left, right in FRAMES
}
#: After a greeting stands one name, or a full one that fills its line.
SIGNED = re.compile(rf"[^\n,]+,[>\s]*{TITLED}(?P<name>{_name(WORD_CAPITAL)}(?=[^\S\n]*(?:\n|$))|{WORD_CAPITAL})")
LISTED = {cue: (re.compile(_loose(left), re.I), re.compile(_loose(between), re.I)) for cue, left, between in LISTS}
TITLE_CUES = {f"{t}{dot} ": re.compile(rf"(?<!\w){t.capitalize()}\.?{GAP}" + NAME_CAPITAL) for t in TITLES for dot in ("", ".")}
ONE_NAME = re.compile(NAME_ANY)
ONE_CAPITAL_NAME = re.compile(NAME_CAPITAL)
MENTION = re.compile(rf"(?<!\w)@(?P<name>{WORD_CAPITAL})(?![\w@.]\w)")

# Names by structure: two or more words that are written like a name, next to a word that tells of a person.

#: A word of a name that is written as one: a capital, then small letters; also O'Neil, McRae and Anne-Marie.
PROPER = r"(?:[^\W\d_a-zß-öø-ÿ](?:['’][^\W\d_a-zß-öø-ÿ])?[a-zß-öø-ÿœšžąćęłńóśźż'’]+(?:[^\W\d_a-zß-öø-ÿ][a-zß-öø-ÿ]+)?(?:-[^\W\d_a-zß-öø-ÿ][a-zß-öø-ÿ]+)*)"
LINE = r"(?:[^\S\n]+|[^\S\n]*\n(?:>[^\S\n]?)*[^\S\n]*)"  # white space within a paragraph
FIRST = rf"(?:{PROPER}(?:{LINE}(?:[^\W\d_a-z]\.{LINE}?)+|{LINE}{PROPER})?|(?:[^\W\d_a-z]\.{LINE}?)+)"
PROPER_NAME = rf"(?P<name>{FIRST}{LINE}?(?<=[\s.>])(?:(?:{'|'.join(PARTICLES)}){LINE}){{0,2}}{PROPER})(?![\w’'-])"

#: Words that join a person to a sentence as often as a thing; behind "in", "at" or an article stands a place or a thing.
JOINED_TO = ["to", "of", "from", "with", "for", "was", "is", "that", "when", "if", "because", "between", "than", "mit", "für", "dass", "avec", "pour", "que", "con", "para", "yesterday", "today", "tomorrow"]

# Words before a name (one acts, is spoken to or is named) and verbs behind it.
PERSON_BEFORE = ["run by", "written by", "prepared by", "reviewed by", "signed by", "approved by", "performed by", "done by", "measured by", "reported by", "requested by", "led by", "sent by", "entered by", "curated by", "annotated by", "spoke with", "spoke to", "talked to", "talked with", "met with", "meeting with", "met", "discussed with", "agreed with", "emailed", "e-mailed", "phoned", "called", "asked", "told", "ask", "tell", "contact", "reach", "dear", "hi", "hello", "hallo", "liebe", "lieber", "cher", "chère", "bonjour", "estimado", "estimada", "hola", "attn", "c/o", "on behalf of", "thanks to", "supervised by", "principal investigator", "my name is", "i am", "this is", "durchgeführt von", "erstellt von", "unterschrieben von", "gesprochen mit", "rédigé par", "réalisé par", "signé par", "parlé avec", "escrito por", "realizado por", "firmado por", "hablé con", "author", "authors", "author:", "operator:", "curator:", "submitter:", "contact:", "name:", "signed:", "name is", "named", "by", "von", "par", "por", "statistician", "technician", "nurse", "postdoc", "student", "colleague", "supervisor", "donor", "patient", "manager", "coordinator", "director", "investigator", "physician", "doctor", "leiter", "leiterin", "kollege", "kollegin", "collègue", "responsable", "directora", "coordinador", "coordinadora", "cc:", "cc", "page", *JOINED_TO]
PERSON_VERBS = ["prepared", "wrote", "said", "says", "reported", "reviewed", "confirmed", "called", "asked", "noted", "suggested", "signed", "replied", "agreed", "explained", "mentioned", "emailed", "e-mailed", "phoned", "thinks", "thought", "lives", "works", "joined", "collected", "measured", "performed", "ran", "schrieb", "sagte", "bestätigte", "a écrit", "a confirmé", "escribió", "confirmó", "dijo"]
SIGN_OFFS = ["regards", "best regards", "kind regards", "warm regards", "best wishes", "best", "sincerely", "yours sincerely", "yours faithfully", "many thanks", "thanks", "thank you", "cheers", "grüße", "mit freundlichen grüßen", "viele grüße", "cordialement", "bien à vous", "saludos", "atentamente", "un saludo"]
BEFORE_NAME = re.compile(rf"(?:,[^\S\n]+|[^\S\n]*:?{LINE}){TITLED}{PROPER_NAME}")
NEXT_NAME = re.compile(rf"(?:,{LINE})?(?:,|{LINE}(?:and|und|et|y|&)){LINE}{TITLED}{PROPER_NAME}")
JOINED = re.compile(r"(?<!\w)(?:and|und|et|y|but|while|as|that|dass|que)\Z", re.I)
BEFORE_VERB = re.compile(rf"(?<![\w’'.-]){PROPER_NAME}{GAP}\Z")
OFF_LINE = re.compile(rf"[,!.]?[^\S\n]*\n(?:[>\s]*){TITLED}{PROPER_NAME}[^\S\n]*(?=\n|\Z|,)")

# Words that no person's name holds: of firms, places, methods and documents; days and months.
IMPERSONAL = set("gmbh inc ltd llc corp ag sa plc co company group labs lab laboratory laboratories reagents biotech biosciences bioscience biologics pharma pharmaceuticals diagnostics therapeutics systems solutions technologies instruments university universität université universidad institute institut instituto hospital clinic klinik department center centre zentrum school college faculty foundation society association agency ministry council committee board team assay protocol method scheme score test kit buffer medium panel table figure trial study cohort version record records sample plate lane rack bench room street road avenue lane park city county state hotel station airport monday tuesday wednesday thursday friday saturday sunday january february march july september october november december the this that these those a an and or for with from our your their we you they it he she if when please note see all no yes not how what why where which deep single multiple cells scientific homo mus das die ein eine patient patients donor donors doctor author authors nurse western southern northern eastern blot human resources san santa los las saint new north south east west medical national international general royal central cell gene flow sales support customer service data quality control science sciences research clinical safety review".split())
JOINING = {"and", "or", "for", "with", "from", "the", "this", "if", "when", "please", "see", "a", "an", "all", "not", "no", "our", "your", "we", "you", "they", "it", "he", "she", "note", "yes"}
NEXT_WORD = re.compile(r"[^\S\n]+([^\W\d_]+)")
IMPERSONAL_ENDS = re.compile(r"(?:tec|tech|metry|graphy|ology|scopy|omics|ation|ysis|virus|plasma|bacter|bacteria|coccus|myces)$")

# Words that follow the same phrases but are no names.
NO_NAMES = {"the", "a", "an", "this", "that", "all", "our", "us", "you", "them", "it", "we", "for", "curators", "everyone", "team", "colleagues", "data", "no", "one", "his", "her", "see", "please"}


def _plausible(name: str) -> bool:
    words = re.findall(r"[^\W\d_]+", name)
    return bool(words) and words[0].lower() not in NO_NAMES and any(len(w) > 1 for w in words)


def _personal(name: str) -> bool:
    words = [w.lower() for w in re.findall(r"[^\W\d_]+", name)]
    return words[0] not in ("der", "den", "dem") and not any(len(w) > 1 and (w in IMPERSONAL or w in TITLES or IMPERSONAL_ENDS.search(w)) for w in words)


def names_by_structure(text: str, at: int, size: int, use: str) -> list[Span]:
    """Full names next to the word at position ``at``: behind a word of PERSON_BEFORE or a sign-off, or before a verb.

    Behind a word there may be several, joined by commas and "and".
    """
    if at and text[at - 1].isalnum() or at + size < len(text) and text[at + size].isalnum():
        return []
    if use == "verb":
        first = at
        for _ in range(6):  # words of a name
            while first and text[first - 1].isspace():
                first -= 1
            while first and not text[first - 1].isspace():
                first -= 1
        found = next(BEFORE_VERB.finditer(text, first, at), None)
        before = found.start() if found else 0
        while before and text[before - 1].isspace():
            before -= 1
        starts = before == 0 or text[before - 1] in ".!?:;,)-\"" or found and "\n" in text[before : found.start()] or JOINED.search(text, max(0, before - 6), before)
        found = found if starts else None
    else:
        found = (OFF_LINE if use == "off" else BEFORE_NAME).match(text, at + size)
    names = []
    while found and _personal(found["name"]):
        after = NEXT_WORD.match(text, found.end("name"))
        if after and after[1].lower() in IMPERSONAL - JOINING:
            break
        names.append(Span("person_name", found.start("name"), found.end("name")))
        found = NEXT_NAME.match(text, found.end("name")) if use == "before" else None
    return names


def names_at(text: str, at: int, cue: str) -> list[Span]:
    """Names that the cue at position ``at`` introduces."""
    found: list[Span] = []
    if cue in LISTED:
        left, between = LISTED[cue]
        if m := left.match(text, at):
            at_name = m.end()
            while n := (ONE_CAPITAL_NAME.match(text, at_name) or ONE_NAME.match(text, at_name)):
                found.append(Span("person_name", n.start("name"), n.end("name")))
                if not (b := between.match(text, n.end())):
                    break
                at_name = b.end()
            found = _split_list(text, found)
    elif cue in FRAMED:
        framed, bare = FRAMED[cue]
        m = framed.match(text, at) or bare.match(text, at)
        if m:
            found.append(Span("person_name", m.start("name"), m.end("name")))
    elif cue in SIGNATURES:
        if m := SIGNED.match(text, at):
            found.append(Span("person_name", m.start("name"), m.end("name")))
    elif cue in TITLE_CUES:
        if m := TITLE_CUES[cue].match(text, at):
            found.append(Span("person_name", m.start("name"), m.end("name")))
    elif cue == "@":
        if m := MENTION.match(text, at):
            found.append(Span("person_name", m.start("name"), m.end("name")))
    return [s for s in found if _plausible(text[s.start : s.end])]


def _split_list(text: str, found: list[Span]) -> list[Span]:
    """A list read as "Last, First" pairs where its members are full names is split at the commas."""
    parts: list[Span] = []
    for s in found:
        pieces = [p for p in re.finditer(r"[^,]+", text[s.start : s.end])]
        whole = len(pieces) > 1 and any(re.search(r"\S\s+\S", p.group().strip()) for p in pieces)
        for p in pieces if whole else [re.match(r"(?s).*", text[s.start : s.end])]:
            lead = len(p.group()) - len(p.group().lstrip())
            parts.append(Span(s.kind, s.start + p.start() + lead, s.start + p.end()))
    return parts


# All kinds --------------------------------------------------------------------------------------


class Finder:
    """Finds personal information in one text at a time."""

    def __init__(self) -> None:
        import ahocorasick

        self.cues = ahocorasick.Automaton()
        anchors: dict[str, list[tuple]] = {}

        def add(spelled: str, *use: object) -> None:
            uses = anchors.setdefault(spelled, [])
            if use not in uses:
                uses.append(use)

        for spelled, form in (("@", "@"), ("[at]", "bracket"), ("(at)", "bracket"), ("{at}", "bracket"), ("[ at ]", "bracket"), (" at ", "word")):
            add(spelled, "email", form)
        add("@", "name", "@")
        add("://", "url")
        for d in "0123456789":
            add(d, "digit")
        for words, family in FAMILIES:
            for w in words:
                add(w, "address", family)
        for cue in dict.fromkeys([*FRAMED, *LISTED, *TITLE_CUES, *SIGNATURES]):
            if cue != SIGNATURE_MARK:
                add(cue, "name", cue)
        for cues, kind in ((PHONE_CUES, "phone"), (IDENTITY_CUES, "identity"), (OTHER_NUMBERS, "other")):
            for cue in cues:
                add(cue, "number", kind)
        for words, use in ((PERSON_BEFORE, "before"), (PERSON_VERBS, "verb"), (SIGN_OFFS, "off")):
            for w in words:
                add(w, "person", use)
        for cue, uses in anchors.items():
            self.cues.add_word(cue, (len(cue), cue, uses))
        self.cues.make_automaton()

    def spans(self, text: str | None) -> list[Span]:
        """Non-overlapping occurrences in order of their position."""
        if not text:
            return []
        lower = text.lower()
        if len(lower) != len(text):
            lower = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
        flat = lower.replace("\xa0", " ")
        joined, starts, moved = _unwrapped(flat) if "\n" in flat else (flat, None, None)
        found: list[Span] = []
        urls: list[Span] = []
        last: dict[str, list[tuple[int, str]]] = {"phone": [], "identity": [], "other": []}
        run_end = -1
        for end, (size, cue, uses) in self.cues.iter(joined):
            at = end - size + 1
            if moved is not None:
                k = bisect_right(starts, at) - 1
                at = moved[k] + at - starts[k]
            for use in uses:
                kind = use[0]
                if kind == "digit":
                    if at >= run_end:
                        s, run_end = self._number(text, at, last, run_end)
                        if s:
                            found.append(s)
                elif kind == "number":
                    if not (cue in ("t", "id", "lot", "nie", "dni") and at and flat[at - 1].isalnum()) and not (cue == "t" and at + 1 < len(flat) and flat[at + 1].isalnum()):
                        last[use[1]].append((at + size, cue))
                elif kind == "address":
                    if s := address_at(text, at, size, use[1]):
                        found.append(s)
                elif kind == "person":
                    found += names_by_structure(text, at, size, use[1])
                elif kind == "email":
                    if s := email_at(text, at, use[1]):
                        found.append(s)
                elif kind == "url":
                    if m := URL.match(text, _scheme_start(text, at)):
                        urls.append(Span("url", m.start(), m.end()))
                elif use[1] == "@" or at == 0 or not joined[end - size].isalnum() or not use[1][0].isalpha():
                    found += names_at(text, at, use[1])
        at = flat.find(SIGNATURE_MARK)
        while at >= 0:
            found += names_at(text, at, SIGNATURE_MARK)
            at = flat.find(SIGNATURE_MARK, at + 1)
        rank = {k: i for i, k in enumerate(KINDS)}
        taken = sorted(urls, key=lambda s: s.start) if urls else []
        free: list[Span] = []  # by start, none overlapping; links stand in the way of all but e-mail addresses
        for s in sorted(found, key=lambda s: (rank[s.kind], s.start, -s.end)):
            if taken and s.kind != "email" and _overlaps(taken, s):
                continue
            if not _overlaps(free, s):
                insort(free, s, key=lambda x: x.start)
        return [_trimmed(text, s) for s in free]

    def _number(self, text: str, at: int, last: dict[str, list[tuple[int, str]]], run_end: int) -> tuple[Span | None, int]:
        """The number whose first digit is at ``at``, and up to where its run of digits is done with."""
        low = max(at - 4, run_end, 0)
        lead = BEFORE_DIGIT.search(text, low, at)
        runs = [m for start in range(lead.start(), at + 1) if (m := NUMBERISH.match(text, start))]
        if not runs:
            return None, at + 1

        def cued(kind: str) -> bool:
            for stop, cue in reversed(last[kind][-3:]):
                between = BETWEEN_TAILED.get(cue) or (BETWEEN_IDENTITY if kind == "identity" else BETWEEN)
                if stop <= runs[0].start() and between.fullmatch(text, stop, runs[0].start()) or stop <= at and between.fullmatch(text, stop, at):
                    return True
            return False

        stop = runs[0].end()
        if last["other"] and cued("other"):
            return None, stop
        is_phone, is_identity = cued("phone"), cued("identity")
        # From its letters on, if it has some, else from its digits on: a word before a number is no part of it.
        tried = [runs[0], runs[-1]] if runs[-1].start() > runs[0].start() else runs[:1]
        for run in tried[1:] if text[runs[0].start() : at].strip().lower() in IDENTITY_CUES else tried:
            end = run.end()
            while end > run.start() and not text[end - 1].isalnum():
                end -= 1
            if s := number_at(text, run.start(), end, is_phone, is_identity):
                return s, stop
        if stop - at > 32:  # a long row of numbers: go on behind its first group
            return None, GROUP.match(text, at).end()
        return None, stop


GROUP = re.compile(r"\w+")

#: The line of two dashes and a blank over a signature.
SIGNATURE_MARK = "-- \n"
URL = re.compile(r"[a-z][a-z0-9+.-]*://[^\s<>\"]+", re.I)


def _scheme_start(text: str, at: int) -> int:
    while at and (text[at - 1].isalnum() or text[at - 1] in "+.-"):
        at -= 1
    return at


def _overlaps(sorted_spans: list[Span], s: Span) -> bool:
    """Whether ``s`` overlaps one of the spans, which do not overlap one another."""
    k = bisect_right(sorted_spans, s.start, key=lambda x: x.start)
    return bool(k and sorted_spans[k - 1].end > s.start) or k < len(sorted_spans) and sorted_spans[k].start < s.end


def _unwrapped(text: str) -> tuple[str, list[int], list[int]]:
    """The text with each wrapped line end as one blank, and where its stretches come from."""
    out: list[str] = []
    starts, moved = [0], [0]
    last = size = 0
    for m in WRAP.finditer(text):
        out.append(text[last : m.start()])
        size += m.start() - last
        out.append(" ")
        starts.append(size)
        moved.append(m.start())
        size += 1
        last = m.end()
        starts.append(size)
        moved.append(last)
    out.append(text[last:])
    return "".join(out), starts, moved


WRAP = re.compile(r"(?<![^\S\n])[^\S\n]*\n(?:>[^\S\n]?)*[^\S\n]*")


def _trimmed(text: str, s: Span) -> Span:
    """The span from its first letter, digit or plus sign on."""
    start = s.start
    while start < s.end and not (text[start].isalnum() or text[start] == "+"):
        start += 1
    return Span(s.kind, start, s.end)


def replaced(text: str | None, spans: list[Span]) -> str | None:
    """The text with a typed placeholder for each span, all else unchanged."""
    if text is None:
        return None
    out, last = [], 0
    for s in spans:
        bracket = s.start > last and text[s.start - 1] == "(" and ")" in text[s.start : s.end]
        out += [text[last : s.start - bracket], f"[{s.kind.upper()}]"]
        last = s.end
    return "".join([*out, text[last:]])


def personal_information(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Every occurrence: ``id_column``, pii_kind, start_pos, end_pos (characters from 1), value_text.

    Kinds are email, phone, id_number, street_address and person_name. What lies inside an address
    or e-mail address is no occurrence of its own. Whole texts are read, each by itself; null and
    empty texts give nothing, repeated documents are each reported.
    """
    id_type = documents.schema[id_column].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            source, kind, start, end, value = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                for s in finder.spans(text):
                    source.append(k)
                    kind.append(s.kind)
                    start.append(s.start + 1)
                    end.append(s.end)
                    value.append(text[s.start : s.end])
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column).take(pa.array(source, pa.int64())), pa.array(kind, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(value, pa.string())],
                [id_column, "pii_kind", "start_pos", "end_pos", "value_text"],
            )

    return documents.select(id_column, "text").mapInArrow(find, f"{id_column} {id_type}, pii_kind string, start_pos int, end_pos int, value_text string")


def redacted(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Each document with typed placeholders: ``id_column``, text, n_replaced. Null texts stay null."""
    id_type = documents.schema[id_column].dataType.simpleString()

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = [finder.spans(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array([replaced(t, s) for t, s in zip(texts, spans)], pa.string()), pa.array([len(s) for s in spans], pa.int32())],
                [id_column, "text", "n_replaced"],
            )

    return documents.select(id_column, F.col("text")).mapInArrow(redact, f"{id_column} {id_type}, text string, n_replaced int")
