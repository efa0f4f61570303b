"""Problem 2: personal data in free text: found, replaced by typed placeholders, or pseudonymised.

One pass over a text runs a recogniser for each kind; overlaps are settled by kind (an address holds its
numbers, an e-mail its names). Numbers are validated against what they could be mistaken for: sums,
versions, prices, long counts. Pseudonyms are format-preserving: the digits and letters of a validated
number or birth date are permuted by a keyed Feistel network within their own format, so equal values
get equal pseudonyms in every document while separators and lengths stay.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.plans.runtime import ensure_spread

PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[PERSON]"}
#: Kinds that win where two findings overlap come first.
ORDER = ("email", "address", "id_number", "phone", "name")

# --- e-mail -------------------------------------------------------------------------------------------
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_LOCAL = r"[A-Za-z0-9_](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_])?"
_DOT = r"(?:\.|\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s)"
EMAIL = re.compile(
    rf"(?<![\w.+-]){_LOCAL}(?:"
    rf"\s?[@＠]\s?{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}}"
    rf"|\s?[\[(]\s?at\s?[\])]\s?{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[A-Za-z]{{2,}}"
    rf"|\sat\s{_LABEL}(?:\sdot\s{_LABEL})*\sdot\s[A-Za-z]{{2,}}"
    r")(?![\w-])",
    re.IGNORECASE,
)

_SPELT = re.compile(r"[\[(]\s?at\s?[\])]|\sdot\s", re.IGNORECASE)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" in text or "＠" in text or _SPELT.search(text):
        yield from (m.span() for m in EMAIL.finditer(text))


# --- identity numbers ---------------------------------------------------------------------------------
_FREE = r"(?<![\w₹$€£.,/#-])(?<!\d[ .])"
_END = r"(?![\w%]|[-./,]\d|[ ]\d{4}\b)"
ID_FORMS = re.compile(
    _FREE + r"(?:"
    r"\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}"  # social security
    r"|\d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}"  # twelve digits in fours
    r"|[A-Za-z]{2} \d{2} \d{2} \d{2} [A-Za-z]|[A-Za-z]{2}\d{6}[A-Da-d]"  # national insurance
    r"|[A-Z]{5}\d{4}[A-Z]"  # permanent account
    r")" + _END
)
ID_BY_CONTEXT = re.compile(_FREE + r"(?:\d{12}|\d{9}|[A-Za-z]\d{7,8}|[A-Za-z]{2}\d{7}|[A-Za-z]{5}\d{4}[A-Za-z])" + _END)
ID_WORDS = re.compile(
    r"\b(?:passport|identity|social|ssn|tax|national|aadhaar|aadhar|pan|permanent account|insurance|licen[cs]e|background check|my id|scan of|"
    r"ausweis|steuer\w*|dni|nie|nif|cédula|passeport|pasaporte|pass-?nr|identité|identidad|uid|itin|tin)\b",
    re.IGNORECASE,
)

# --- phones -------------------------------------------------------------------------------------------
_B = r"(?<![\w₹$€£.,:/#+(-])(?<!\d[ ])"
_E = r"(?![\w%]|[.,:/-]\d|[ ]\d{3})"
PHONE = re.compile(
    _B + r"(?:"
    r"(?:\+|00)\d{1,3}[ .-]?(?:\(0\)|\(\d{1,5}\))?[ .-]?\d{1,5}(?:[ .-]?\d{2,5}){1,4}"  # with a country code
    r"|\+\d{9,14}"
    r"|\(\d{2,4}\)[ .-]?\d{3,5}[ .-]\d{4,6}"  # area code in brackets
    r"|1?[.-]?\d{3}[.-]\d{3}[.-]\d{4}"
    r"|1\.\d{3}\.\d{3}\.\d{4}"
    r"|\d{3} \d{3} \d{4}"
    r"|0\d{2,5}[ -]\d{3,5}(?:[ -]\d{3,4})?"  # trunk prefix
    r"|\d(?: \d){9}"  # spaced out
    r"|[5-9]\d{9}"
    r")" + _E
)
NOT_COUNTED = re.compile(r"\s*(?:rows|users|requests|records|items|bytes|keys|ids|events|messages|entries|lines|times|ms|ns)\b", re.IGNORECASE)
NUMBER_CONTEXT = re.compile(r"(?:\b(?:sum|constant|epoch|value|range|version|build|ticket|output|input|score|modulo|seed|hash|array|sequence|req|slot)\b[^.!?\n]{0,25})$", re.IGNORECASE)

# --- addresses ----------------------------------------------------------------------------------------
_W = r"[^\W\d_][\w'’-]*"
_SECOND = r"(?: (?:Falls|Hill|Mere|Bay|Park|City|Heights|Valley|Springs|Beach|Grove|Creek|Junction|Point|Green|Cross|Bridge|Harbour|Harbor|Ridge|Haven|Wells|Hills|Lake))?"
_TOWN = rf"(?:{_W}{_SECOND})"
_WAY = r"(?:Road|Rd\.?|Street|St\.?|Lane|Ln\.?|Close|Avenue|Ave\.?|Drive|Dr\.?|Court|Ct\.?|Way|Place|Square|Boulevard|Blvd\.?|Terrace|Crescent|Gardens|Row|Highway|Walk)"
_UNIT = r"(?:, (?:Unit|Suite|Apt\.?|Apartment|Floor|Flat|Room|#) ?[\w-]+)"
_CODE = r"(?:[A-Z]{1,2}\d{1,2}[A-Z]? \d[A-Z]{2}|[A-Z]{2} \d{5}|\d{3} \d{3}|\d{5,6}|\d{4} [A-Z]{2})"


def _address(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![\w/])(?:{pattern})(?!\w)", re.IGNORECASE)


#: (what a text must hold in lower case for the form to be sought, form).
ADDRESSES = [
    (("sector",), _address(rf"H\. ?No\.? ?\d+(?:/\d+)?[A-Za-z]?, Sector \d+, {_TOWN}(?: ?[-–] ?\d{{6}})?|\d+/\d+, Sector \d+, {_TOWN}(?: ?[-–] ?\d{{6}})?")),
    (("flat ",), _address(rf"Flat (?:No\.? ?)?\w+, [^\n,;]+, (?:[^\n,;]+, ){{0,3}}{_TOWN} (?:\d{{3}} ?\d{{3}})")),
    (("box ",), _address(rf"P\. ?O\. ?Box \d+, {_TOWN}(?:,? {_CODE})?")),
    (("weg ", "straße ", "strasse ", "gasse ", "allee ", "platz ", "ring ", "damm ", "ufer "), _address(rf"{_W}(?:weg|straße|strasse|gasse|allee|platz|ring|damm|ufer) \d+[a-z]?, \d{{4,5}} {_TOWN}")),
    (
        ("rue ", "avenue ", "boulevard ", "place ", "impasse ", "allée ", "chemin ", "quai ", "calle ", "via "),
        _address(rf"\d+(?: ?(?:bis|ter))?,? (?:rue|avenue|boulevard|place|impasse|allée|chemin|quai|calle|via)(?: (?:de|du|des|la|le|del))* {_W}(?:[ -]{_W})?, \d{{5}} {_TOWN}"),
    ),
    (("calle ", "avenida ", "plaza ", "paseo "), _address(rf"(?:calle|avenida|plaza|paseo) {_W}(?: {_W}){{0,2}},? \d+,(?: \d{{5}})? {_TOWN}")),
]
_NUMBER_FIRST = _address(rf"\d+[a-z]? (?:St\. )?{_W}(?: {_W}){{0,2}} {_WAY}{_UNIT}?, {_TOWN}(?:,? {_CODE})?")
_NUMBER = re.compile(r"\d+[a-z]? ", re.IGNORECASE)
_CODE_FIRST = _address(rf"{_CODE} {_TOWN}, {_W}(?: {_W}){{0,2}} {_WAY} \d+[a-z]?")
_NUMBERED_WAY = re.compile(rf" {_WAY} \d", re.IGNORECASE)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    for signs, form in ADDRESSES:
        if any(x in low for x in signs):
            yield from (m.span() for m in form.finditer(text))
    for m in _NUMBER.finditer(text):  # the pattern is tried at numbers only
        if found := _NUMBER_FIRST.match(text, m.start()):
            yield found.span()
    if _NUMBERED_WAY.search(text):
        yield from (m.span() for m in _CODE_FIRST.finditer(text))


# --- names --------------------------------------------------------------------------------------------
#: Given names of several languages that identify a person without further context.
GIVEN = frozenset(
    "Aarav Aditi Aisha Ahmed Alejandro Alice Amara Amelia Amir Ananya Anders Andrea Andrei Anita Anjali Anna Antoine Arjun Astrid Bastian "
    "Beatriz Bruno Camille Carlos Carmen Chen Chloe Claire Clara Daniela David Deepak Devika Diego Dmitri Elena Elias Elif Emeka Emma Erik "
    "Fatima Farah Felix Fiona Francesca Freya Gabriela Giulia Greta Hana Hannah Hans Hiroshi Hugo Ilse Ines Ingrid Isabel Ivan Jamal Jana "
    "Javier Jonas Jorge Julia Kabir Karan Katya Kavya Kenji Lars Laura Lena Leila Liam Lin Linnea Luca Lucas Lucia Magnus Mai Marco Marek "
    "Maria Marie Mateo Maya Meera Mei Miguel Mina Mohammed Nadia Neha Niamh Nikhil Nina Noor Olga Omar Oskar Pablo Paula Pedro Petra Pooja "
    "Pierre Priya Priyanka Rahul Raj Ravi Rohan Rosa Ruth Sakura Samir Sandeep Sanjay Sanvi Sara Sergei Simran Sofia Sofie Sunita Tanvi Tara "
    "Thomas Tobias Tomas Valentina Vikram Yara Yusuf Zainab Zoe".split()
)
#: Words that start a sentence or a label, never a surname.
STARTERS = frozenset(
    "The An They Then There These This That Those Two Three Four Both Some Somebody Someone Our Out On Once One In If It Its At As After Again "
    "Also And Another Any Before But By For Friends From He Her His She How However Later Looking Right Next My Me Not Of Or So Since Still "
    "Such Sleep Take Tell Testing To Towards Two Until Was We What When Where While Who Why With Without Write You Your Do During Each Even "
    "Every Following Honestly No Nobody Now Overall Somewhat Team Panel Room Block Ticket Slot Score Version Epoch Output Input Call Contact "
    "Email Mail Phone Ph Tel Mobile WhatsApp Address Candidate Interviewer Written Thanks Merci Regards Home Question Look Round Red Label "
    "Tax National Passport Salary Happy Edit Update Sharing Sincerely Cheers El La Los Las Un Una Con Mi Me Para Al En Tras Después Qué "
    "Die Der Das Ein Eine Nach Am Zum Mit Für Meine Mein Ich Wir Es Bei Je Le Les Mon Ma Après Avec Pour Il Elle Dans On Reach DM Ask "
    "Online Machine System Technical Coding Culture Managerial Behavioural Debugging Data Hiring Group Telephonic Final First Second Third "
    "Fourth Fifth Sixth Video Tech Onsite Interview Background Verdict Advice Tips Preparation Timeline Feedback Compensation".split()
)
_TITLE = r"(?:(?:Dr|Mr|Mrs|Ms|Prof|Mx|Herr|Frau|Sr|Sra|Mme)\.? )?"
_TOK = r"[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+(?:['’][A-Z][a-z]+)?"
_PART = rf"{_TOK}(?:-{_TOK})?"
_NAME = rf"(?:{_PART}|[A-Z]\.)(?: [A-Z]\.)?(?: {_PART}){{0,3}}"
#: (what a text must hold for the phrase to be sought, phrase that comes before a name).
NAME_BEFORE = [
    ("interviewed by ", r"interviewed by "), ("themself as ", r"themself as "), ("imself as ", r"himself as "), ("erself as ", r"herself as "), ("yself as ", r"myself as "), ("signed ", r"signed [\"“']"),
    ("recruiter", r"recruiter,? "), ("reclutador", r"reclutador,? "), ("reclutadora", r"reclutadora,? "), ("Ansprechperson", r"Ansprechperson war "), ("anager would", r"[Mm]anager would have been "),
    ("hanks to ", r"Thanks to "), ("hank you", r"Thank you,? "), ("Merci", r"Merci à "), ("Gracias", r"Gracias a "), ("Danke", r"Danke an "), ("first met ", r"[Ii] first met "), ("First I met", r"First I met "),
    ("Hi all", r"Hi all, "), ("Hello", r"Hello,? I am "), (" am ", r"[Ii] am "), ("y name is ", r"[Mm]y name is "), ("Name: ", r"Name: "), ("ame", r"\| ?[Nn]ame ?\| "), ("Later ", r"Later (?=(?:Mr|Ms|Mrs|Dr|Mx)\.)"),
    ("ritten by ", r"[Ww]ritten by "), ("Interviewer: ", r"Interviewer: "), ("Recruiter: ", r"Recruiter: "), ("Panel: ", r"Panel: "), ("Candidate", r"Candidate:? "), ("cc ", r"\bcc "), ("anel was ", r"[Pp]anel was "),
    ("still remember ", r"still remember "), ("et ", r"\b[Mm]et "), ("Regards,", r"Regards,\s+"), ("Cheers,", r"Cheers,\s+"), ("Best,", r"Best,\s+"), ("Thanks,", r"Thanks,\s+"), ("Sincerely,", r"Sincerely,\s+"),
    ("—", r"(?:^|(?<=\s))— ?"), ("–", r"(?:^|(?<=\s))– ?"),
]


@functools.lru_cache(maxsize=4096)
def _before(phrases: tuple[str, ...]) -> re.Pattern:
    return re.compile(rf"(?:{'|'.join(phrases)}){_TITLE}(?P<n>{_NAME})")


_CHAIN = re.compile(rf"(?: and | / | & |, then | y | und | et ){_TITLE}(?P<n>{_NAME})")
_AFTER_SIGNS = ("asked me", "from the talent", "who leads", "took over", "here, sharing", "replied within", "joined the call", "llamó dos veces", "pour la recommandation", "for the referral", "for the missing", "s question")
#: Two or more capitalised words where a sentence is about talking to somebody, or about what somebody did.
_PAIR = rf"{_PART}(?: [A-Z]\.)? {_PART}"
_TALK = re.compile(rf"\b(?:spoke|speaking|talked|talking|chatted|chatting|interviewed|a call|a chat|sat down|worked) with {_TITLE}(?P<n>{_PAIR})")
_TALK_SIGNS = ("spoke with ", "speaking with ", "talked with ", "talking with ", "chatted with ", "chatting with ", "nterviewed with ", "a call with ", "a chat with ", "sat down with ", "orked with ")
_DID = re.compile(rf"(?<![\w@.-]){_TITLE}(?P<n>{_PAIR})(?= (?:led the|ran the|joined the|conducted the|introduced (?:him|her|them)self|walked me|told me|called me|greeted me|said (?:that|he|she|they)))")
_DID_SIGNS = ("led the", "ran the", "joined the", "conducted the", "introduced ", "walked me", "told me", "called me", "greeted me", "said ")
_AFTER = re.compile(rf"(?<![\w@.-]){_TITLE}(?P<n>{_NAME})(?=,? (?:asked me|from the talent|who leads|took over|here, sharing|replied within|joined the call|llamó dos veces|pour la recommandation|for the referral|for the missing)|['’]s question)")
_TITLED = re.compile(rf"(?<!\w)(?:Dr|Mr|Mrs|Ms|Mx|Prof)\. (?P<n>{_NAME})")
_GIVEN = re.compile(rf"(?<![\w@.＠-])(?P<n>(?:[A-Z]\. )?(?:{'|'.join(sorted(GIVEN))})(?:-{_TOK})?(?: [A-Z]\.)?(?: {_PART}){{0,3}})(?![\w@＠])")
_PLACES = re.compile(r"(?:Labs|Systems|Networks|Robotics|Analytics|Software|Cloud|Health|Logistics|Payments|Semiconductors|Interactive|Inc|Ltd|GmbH|Corp|Foods|Airlines|Round|Round-?Robin|Residency|University|College|Bank)$")


_CAPITAL = re.compile(r"[A-Z][a-zà-öø-ÿ]+")
_TITLES = ("Dr. ", "Mr. ", "Mrs. ", "Ms. ", "Mx. ", "Prof. ")
#: Words of roles and teams, which stand where a person could.
_ROLE = re.compile(r"\b(?:Engineer|Engineers|Developer|Manager|Managers|Director|Lead|Leads|Architect|Analyst|Scientist|Designer|Team|Teams|Group|Department|Recruiter|Recruiters|Master|Owner|Officer|Panel|Tester|Writer|Administrator|Support|Human|Resources|Science|Learning|Product|Software|Talent|Staff|Senior|Junior|Principal)\b")


def _trim_name(text: str, start: int, end: int, context: bool) -> tuple[int, int] | None:
    """Cut a name's tail where another sentence or a business begins; None if nothing of it is a name."""
    words = text[start:end].split(" ")
    keep, surnames = 0, 0
    for i, w in enumerate(words):
        if i and re.fullmatch(r"[A-Z]\.", w):
            nxt = words[i + 1] if i + 1 < len(words) else ""
            # an initial between names, or one that ends the name ("Mateo D.")
            if surnames or (nxt in STARTERS):
                keep = i + 1 if not surnames else keep
                break
            keep = i + 1
            continue
        if w in STARTERS or w.split("-")[0] in STARTERS or _PLACES.search(w):
            if i and _PLACES.search(w) and keep > 1 and surnames:
                keep -= 1  # the word before belongs to the business
            break
        if i and w in GIVEN and surnames:
            break
        if i:
            if surnames == 2:
                break
            if surnames == 1 and i + 1 <= len(words):
                after = text[start + len(" ".join(words[: i + 1])) :][:24]
                if re.match(r" [a-z]", after) and not re.match(r" (?:for|asked|took|from|here|replied|llam|pour|joined|and|in|who|y|und|et)\b", after):
                    break
            surnames += 1
        elif re.fullmatch(r"[A-Z]\.", w):
            pass
        keep = i + 1
    if not keep:
        return None
    name = " ".join(words[:keep])
    if re.fullmatch(r"[A-Z]\.", name):
        return None
    if not context and words[0].split("-")[0] not in GIVEN:
        return None
    # the dot of a final initial belongs to the name, as in "Mateo D."
    return start, start + len(name)


def _names(text: str) -> Iterator[tuple[int, int]]:
    phrases = tuple(p for sign, p in NAME_BEFORE if sign in text)
    for m in _before(phrases).finditer(text) if phrases else ():
        got = _trim_name(text, m.start("n"), m.end("n"), True)
        while got:
            yield got
            m2 = _CHAIN.match(text, got[1])
            if not m2 and re.match(r" (?:took over|,)", text[got[1] :][:10]):
                break
            if not m2:
                break
            got = _trim_name(text, m2.start("n"), m2.end("n"), True)
    forms = []
    if any(x in text for x in _AFTER_SIGNS):
        forms.append((_AFTER, True))
    if any(x in text for x in _TITLES):
        forms.append((_TITLED, True))
    if not GIVEN.isdisjoint(_CAPITAL.findall(text)):
        forms.append((_GIVEN, False))
    for pattern, context in forms:
        for m in pattern.finditer(text):
            if got := _trim_name(text, m.start("n"), m.end("n"), context):
                yield got
    for pattern, signs in ((_TALK, _TALK_SIGNS), (_DID, _DID_SIGNS)):
        for m in pattern.finditer(text) if any(x in text for x in signs) else ():
            got = _trim_name(text, m.start("n"), m.end("n"), True)
            while got and " " in text[got[0] : got[1]] and not _ROLE.search(text, *got) and not _PLACES.search(text[got[0] : got[1]]):
                yield got
                m2 = _CHAIN.match(text, got[1])
                got = _trim_name(text, m2.start("n"), m2.end("n"), True) if m2 else None


_DIGITS = re.compile(r"\d{4}|\d[ -]\d\d[ -]\d")


def _ids(text: str) -> Iterator[tuple[int, int]]:
    if not _DIGITS.search(text):  # every form holds four digits together, or pairs of them
        return
    for m in ID_FORMS.finditer(text):
        before = text[max(0, m.start() - 45) : m.start()]
        if re.search(r"\b(?:label|class|ticket|sum|range|version|value|constant)\b[^.!?\n]{0,20}$", before, re.IGNORECASE):
            continue
        yield m.span()
    for m in ID_BY_CONTEXT.finditer(text):
        around = text[max(0, m.start() - 60) : m.start()].rpartition("\n")[2] + " " + text[m.end() : m.end() + 40].partition("\n")[0]
        if ID_WORDS.search(around) and not re.search(r"\b(?:label|class)\b", around[-60:], re.IGNORECASE):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        found = m.group()
        digits = re.sub(r"\D", "", found)
        if not 9 <= len(digits) <= 15:
            continue
        if NOT_COUNTED.match(text, m.end()) or NUMBER_CONTEXT.search(text[max(0, m.start() - 45) : m.start()]):
            continue
        if found.isdigit() and re.search(r"0{6,}", found):
            continue
        yield m.span()


RECOGNISERS = {
    "email": _emails,
    "address": _addresses,
    "id_number": _ids,
    "phone": _phones,
    "name": _names,
}


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the personal data in ``text``, in order, without overlaps."""
    taken: list[tuple[int, int, str]] = []
    for kind in ORDER:
        spans = sorted(set(RECOGNISERS[kind](text)), key=lambda s: (s[0], -s[1]))
        for start, end in spans:
            if start < end and not any(start < e and s < end for s, e, _ in taken):
                taken.append((start, end, kind))
    return sorted(taken)


def redact(text: str) -> str:
    """The text with typed placeholders; everything else unchanged."""
    out, at = [], 0
    for start, end, kind in find(text):
        out += [text[at:start], PLACEHOLDERS[kind]]
        at = end
    return "".join([*out, text[at:]])


# --- pseudonyms ---------------------------------------------------------------------------------------
def feistel(value: int, size: int, key: bytes, tweak: bytes, rounds: int = 10) -> int:
    """A keyed permutation of 0..size-1: a balanced Feistel network over the next even number of bits,
    walked until it lands inside."""
    bits = max(2, (size - 1).bit_length())
    half = (bits + 1) // 2
    mask = (1 << half) - 1
    width = (half + 7) // 8
    while True:
        a, b = value >> half, value & mask
        for r in range(rounds):
            h = hashlib.blake2b(b.to_bytes(width, "big"), key=key, person=tweak[:16], salt=bytes([r]), digest_size=min(64, width + 8)).digest()
            a, b = b, a ^ (int.from_bytes(h, "big") & mask)
        value = (a << half) | b
        if value < size:
            return value


def permute_format(value: str, key: bytes) -> str:
    """``value`` with its ASCII digits and letters permuted together, each within its own alphabet; signs and
    case pattern stay. Values that differ only in their signs stay linked."""
    alphabets, digits = [], []
    for c in value:
        if "0" <= c <= "9":
            alphabets.append("0123456789")
        elif "A" <= c <= "Z":
            alphabets.append("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        elif "a" <= c <= "z":
            alphabets.append("abcdefghijklmnopqrstuvwxyz")
        else:
            alphabets.append("")
        digits.append(alphabets[-1].find(c) if alphabets[-1] else 0)
    size, number, form = 1, 0, ""
    for a, d in zip(alphabets, digits, strict=True):
        if a:
            size, number, form = size * len(a), number * len(a) + d, form + ("9" if len(a) == 10 else "a")
    if size < 10:
        return value
    number = feistel(number, size, key, hashlib.blake2b(form.encode(), digest_size=16).digest())
    out = []
    for c, a in zip(reversed(value), reversed(alphabets), strict=True):
        if a:
            number, d = divmod(number, len(a))
            out.append(a[d])
        else:
            out.append(c)
    return "".join(reversed(out))


def _replace_digits(value: str, at: list[int], digits: str) -> str:
    out = list(value)
    for i, d in zip(at, digits, strict=True):
        out[i] = d
    return "".join(out)


def _walk(digits: str, key: bytes, valid) -> str:  # noqa: ANN001
    """Permute ``digits`` until the outcome is as valid as they are: a permutation of the valid and of the others."""
    wanted = valid(digits)
    while True:
        digits = permute_format(digits, key)
        if valid(digits) == wanted:
            return digits


def _verhoeff(digits: str) -> int:
    """The checksum in the dihedral group of order ten; 0 for a number with its right check digit."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        for _ in range(i % 8):
            d = _TURN[d]
        a, b = total, d
        total = (a + b) % 5 if a < 5 and b < 5 else 5 + (a + b - 5) % 5 if a < 5 else 5 + (a - 5 - b) % 5 if b < 5 else (a - b) % 5
    return total


#: The permutation of digits of the Verhoeff checksum.
_TURN = (1, 5, 7, 6, 2, 8, 3, 0, 9, 4)


def permute_id(value: str, key: bytes) -> str:
    """An identity number as another one of its kind: twelve digits keep a right check digit right, social security
    numbers stay possible ones, of permanent account numbers the letter for the kind of holder stays."""
    at = [i for i, c in enumerate(value) if "0" <= c <= "9"]
    digits = "".join(value[i] for i in at)
    letters = [i for i, c in enumerate(value) if c.isalpha()]
    if len(digits) == 12 and not letters:
        if _verhoeff(digits):
            return _replace_digits(value, at, _walk(digits, key, lambda x: _verhoeff(x) == 0))
        body = permute_format(digits[:11], key)
        return _replace_digits(value, at, body + next(c for c in "0123456789" if _verhoeff(body + c) == 0))
    if len(digits) == 9 and not letters:
        possible = lambda x: x[:3] not in ("000", "666") and x[0] != "9" and x[3:5] != "00" and x[5:] != "0000"
        return _replace_digits(value, at, _walk(digits, key, possible))
    if re.fullmatch(r"[A-Za-z]{5}\d{4}[A-Za-z]", value):
        moved = permute_format(value[:3] + value[4:], key)
        return moved[:3] + value[3] + moved[3:]
    return permute_format(value, key)


#: Country calling codes of one and two digits; all others have three.
_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def permute_phone(value: str, key: bytes) -> str:
    """A phone number whose national digits are permuted; country code and trunk zero stay apart and unchanged, so a
    number is linked in all its notations."""
    at = [i for i, c in enumerate(value) if "0" <= c <= "9"]
    digits = "".join(value[i] for i in at)
    code = 0
    if value.startswith("+") or digits.startswith("00"):
        code = 0 if value.startswith("+") else 2
        code += next((n for n in (1, 2) if digits[code : code + n] in _CODES), 3)
    elif len(digits) == 11 and digits[0] == "1":
        code = 1
    while code < len(digits) - 4 and digits[code] == "0":
        code += 1
    return _replace_digits(value, at[code:], permute_format(digits[code:], key))


_JOINT = re.compile(r"(\s?[\[(]\s?(?:at|dot)\s?[\])]\s?|\s(?:at|dot)\s|\s?[@＠]\s?|\.)", re.IGNORECASE)
_AT = re.compile(r"\s?[@＠]\s?|\s?[\[(]\s?at\s?[\])]\s?|\sat\s", re.IGNORECASE)
_SECOND_LEVEL = frozenset("co com org net ac gov edu".split())


def permute_email(value: str, key: bytes) -> str:
    """An address whose local part and domain labels are permuted each for itself: equal domains stay linked, and
    the top-level domain stays a real one."""
    m = _AT.search(value)
    if not m:
        return permute_format(value, key)
    parts = _JOINT.split(value[m.end() :])
    labels = list(range(0, len(parts), 2))
    kept = 2 if len(labels) > 2 and len(parts[labels[-1]]) == 2 and parts[labels[-2]].lower() in _SECOND_LEVEL else 1
    for i in labels[:-kept]:
        parts[i] = permute_format(parts[i], key)
    return permute_format(value[: m.start()], key) + m.group() + "".join(parts)


_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_000
BIRTH_DATE = re.compile(r"(\b(?:born|date of birth|birth ?date|birthday|dob|d\.o\.b\.?|birth)(?: on| is| was)?[:\s]\s?)(?:(\d{4})-(\d{2})-(\d{2})|(\d{1,2})([./-])(\d{1,2})\6(\d{4}))\b", re.IGNORECASE)


def _moved_date(year: int, month: int, day: int, key: bytes) -> datetime.date | None:
    try:
        n = datetime.date(year, month, day).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    return datetime.date.fromordinal(feistel(n, _DAYS, key, b"date") + _FIRST_DAY) if 0 <= n < _DAYS else None


def permute_date(iso: str, key: bytes) -> str:
    """A valid date of 1900 to 2099 as another one of that span; anything else unchanged."""
    moved = _moved_date(*map(int, iso.split("-")), key)
    return moved.isoformat() if moved else iso


def _birth_date(m: re.Match, key: bytes) -> str:
    """The date in its notation; days come first unless the year does. A date in two notations has one pseudonym."""
    y, mo, d = (m[2], m[3], m[4]) if m[2] else (m[8], m[7], m[5])
    moved = _moved_date(int(y), int(mo), int(d), key)
    if moved is None:
        return m[0]
    return m[1] + (moved.isoformat() if m[2] else f"{moved.day:02}{m[6]}{moved.month:02}{m[6]}{moved.year}")


_PERMUTED = {"phone": permute_phone, "id_number": permute_id, "email": permute_email}


def pseudonymise(text: str, key: bytes) -> str:
    """Numbers, e-mail addresses and birth dates as keyed pseudonyms of the same format; names and addresses as placeholders."""
    out, at = [], 0
    for start, end, kind in find(text):
        found = text[start:end]
        out += [text[at:start], _PERMUTED[kind](found, key) if kind in _PERMUTED else PLACEHOLDERS[kind]]
        at = end
    return BIRTH_DATE.sub(lambda m: _birth_date(m, key), "".join([*out, text[at:]]))


# --- operators ----------------------------------------------------------------------------------------
def find_personal_data(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pii_type, pii_text), distinct. NULL and empty texts give no rows; texts of any length are
    searched whole; other columns are ignored."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kinds, texts = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for start, end, k in find(t) if t else ():
                    rows.append(i)
                    kinds.append(k)
                    texts.append(t[start:end])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), pa.array(kinds, pa.string()), pa.array(texts, pa.string())], names=[key, "pii_type", "pii_text"])

    return ensure_spread(df.select(key, F.col(text).cast("string").alias("__t"))).mapInArrow(run, f"`{key}` {kind}, pii_type string, pii_text string").distinct()


def _mapped(df: DataFrame, key: str, text: str, change) -> DataFrame:  # noqa: ANN001
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if t is None else change(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[key, text])

    return ensure_spread(df.select(key, F.col(text).cast("string").alias(text))).mapInArrow(run, f"`{key}` {kind}, `{text}` string")


def redact_personal_data(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) with placeholders, one row for each row; NULL stays NULL, an empty text empty."""
    return _mapped(df, key, text, redact)


def pseudonymise_personal_data(df: DataFrame, key: str, text: str, secret: str) -> DataFrame:
    """(key, text) with format-preserving pseudonyms under ``secret``, one row for each row; NULL stays NULL."""
    bound = hashlib.blake2b(secret.encode(), digest_size=32).digest()
    return _mapped(df, key, text, lambda t: pseudonymise(t, bound))
