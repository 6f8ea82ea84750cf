"""Personal information inside free text: found, typed and replaced.

Method: one Aho-Corasick automaton finds anchors (at-signs and their spellings, street words, PO boxes, identifier
cues, titles and other cues of persons); at each anchor a deterministic local parser expands to both sides and
validates the boundaries. Telephone numbers have no literal anchor; their digit groups are found by patterns.
Cues and grammars are general ones of English and Spanish. A name without a cue is found by a common given name before
a surname; there is no list of surnames or places. Time is linear in the length of a text.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMAIL, PHONE, ID_NUMBER, ADDRESS, NAME = "EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME"
_RANK = {EMAIL: 0, ADDRESS: 1, ID_NUMBER: 2, PHONE: 3, NAME: 4}

# Anchors by kind.
_AT = ("@", "(at)", "[at]", "{at}", " at ")
_ID_CUES = {
    "ssn": ("ssn", "ss#", "ss #", "social security", "soc sec", "soc. sec.", "seguro social", "id"),
    "medicare": ("medicare", "beneficiary", "mbi", "hicn"),
    "record": ("mrn", "medical record", "chart", "patient id", "historia clínica", "expediente"),
    "license": ("driver", "licence", "license", "dl", "licencia"),
}
_STREET_WORDS = (
    "street", "st", "avenue", "ave", "road", "rd", "drive", "dr", "lane", "ln", "court", "ct", "way", "pike", "boulevard", "blvd", "place", "pl", "terrace", "ter", "circle", "cir",
    "highway", "hwy", "parkway", "pkwy", "trail", "trl", "square", "sq", "loop", "alley", "county road", "route", "rural route", "state road",
)
_LEADING_STREETS = ("calle", "avenida", "camino", "carretera", "paseo", "plaza", "rue", "via")
_BOXES = ("po box", "p.o. box", "p. o. box", "p.o box", "p o box", "post office box", "apartado")
_TITLES = (
    "mr", "mrs", "ms", "miss", "mx", "dr", "prof", "professor", "rev", "doctor", "sister", "nurse", "lpn", "rn", "cna", "np", "administrator", "surveyor", "sr", "sra", "srta", "dra", "don",
    "doña", "señor", "señora", "señorita", "doctora", "enfermera", "enfermero", "administrador", "administradora",
)
_RELATIONS = (
    "daughter", "son", "wife", "husband", "spouse", "mother", "father", "sister", "brother", "niece", "nephew", "aunt", "uncle", "cousin", "friend", "guardian", "granddaughter", "grandson",
    "aide", "caregiver", "roommate", "resident", "hija", "hijo", "esposa", "esposo", "madre", "padre", "hermana", "hermano", "sobrina", "sobrino", "nieta", "nieto", "tutor", "tutora", "cuidadora", "residente",
)
_LABELS = ("signed", "contact", "contacts", "name", "names", "attn", "attention", "patient", "printer", "witness", "firmado", "contacto", "nombre", "firma", "paciente", "by", "from", "listed", "named", "called", "dear", "estimada", "estimado", "regarding")
# Common given names of English and Spanish, which begin a name without a cue.
_GIVEN = (
    "aaron", "adam", "albert", "alejandro", "alexander", "alice", "amanda", "amy", "andrea", "andrew", "angela", "ann", "anna", "anne", "anthony", "antonio", "arthur", "ashley", "barbara", "benjamin",
    "betty", "beverly", "brandon", "brenda", "brian", "carl", "carlos", "carmen", "carol", "caroline", "carolyn", "catherine", "charles", "cheryl", "christian", "christina", "christine", "christopher", "cynthia", "daniel",
    "david", "deborah", "debra", "denise", "dennis", "diana", "diane", "diego", "donald", "donna", "doris", "dorothy", "douglas", "edward", "elena", "elizabeth", "emily", "emma", "eric", "ethan",
    "eugene", "evelyn", "fernando", "frances", "francisco", "frank", "gabriel", "gary", "george", "gerald", "gloria", "gregory", "guadalupe", "hannah", "harold", "heather", "helen", "henry", "isabel", "jack",
    "jacob", "jacqueline", "james", "jane", "janet", "janice", "jason", "javier", "jean", "jeffrey", "jennifer", "jeremy", "jerry", "jesse", "jessica", "jesús", "joan", "joe", "john", "jonathan",
    "jorge", "josé", "jose", "joseph", "joshua", "joyce", "juan", "juana", "judith", "judy", "julia", "julie", "justin", "karen", "katherine", "kathleen", "kathryn", "keith", "kelly", "kenneth",
    "kevin", "kimberly", "larry", "laura", "lauren", "lawrence", "linda", "lisa", "louis", "lucía", "luis", "manuel", "margaret", "maria", "maría", "marie", "marilyn", "mark", "martha", "mary",
    "matthew", "megan", "melissa", "michael", "michelle", "miguel", "nancy", "nathan", "nicholas", "nicole", "olivia", "pamela", "patricia", "patrick", "paul", "pedro", "peter", "philip", "rachel", "ralph",
    "raymond", "rebecca", "richard", "robert", "roger", "ronald", "rosa", "russell", "ruth", "ryan", "samuel", "sandra", "sarah", "scott", "sharon", "shirley", "sofia", "stephen", "steven", "susan",
)
# Words of places and organisations, which are no surnames and show that the words before them name no person.
_PLACES = frozenset(
    """wing room rooms hall unit station floor suite building clinic hospital hospice nursing home homes care center centre rehab rehabilitation manor village villa gardens garden commons house lodge estates
    residence living health healthcare memorial medical university college school church county city township river lake valley hills heights park bridge airport foundation fund act award day street st avenue ave road rd
    drive lane ln court boulevard blvd parkway pkwy highway hwy terrace circle plaza square entrance pavilion tower towers ward lounge library chapel store pharmacy company inc llc corp""".split()
)
#: Words that name places or streets in front of a given name, and the article before a thing named after a person.
_BEFORE_PLACE = frozenset("the saint st san santa santo mount mt fort ft port lake camp isla rue calle".split())
# Particles inside surnames.
_PARTICLES = frozenset("de del la las los da di do dos du van von der den ter bin al el san y e".split())
_AFTER = ("moved out", "moved in", "moved to", "has moved", "se mudó")

# Words that end a name or cannot begin one.
_STOP = frozenset(
    """a about after again al an and another any are as asked asks at be because been before being but by call called came can case charge con could date de del desde did dijo do does
    during each el ella en entre every explained facility family father for form from had has have he her here him his home how i if in into is it its la las left letter listed lo los mail
    may me mentioned mother moved must my near new no nor not note noted of off office on one or our out over para per pero phone pidió por que reached received reported room said saw
    says se sent she should signed since so some stated staff su than that the their them then there these they this those to told un una under until was we were what when where
    which while who whose will with would wrote y you your tel fax cell email e-mail id ssn mrn dob ext resident residents desk duty call medicare social security license licence driver chart
    assistant aide station manager director supervisor practitioner team log cart room rounds also both either neither observed agreed denied confirmed answered added gave took went
    reports shows showed knew thought felt checked found made met spoke works worked began returned requested wants wanted"""
    .split()
)

_L = r"[^\W\d_]"
_WORD = rf"{_L}++(?:['’‘]{_L}++)*+(?:-{_L}++(?:['’]{_L}++)?+)*+"  # possessive, so that long runs are read once
_TOKEN = re.compile(rf"({_L})\.(?!{_L}{{2}})|{_WORD}")
_GAP = re.compile(r"[ \t\xa0]+|[ \t]*\n[ \t]*")

_LOCAL_CHARACTER = re.compile(r"[A-Za-z0-9À-ɏ._%+'-]")
_LOCAL_END = re.compile(r"[A-Za-z0-9À-ɏ_%+-]")
_DOT = r"(?:\.|[ ]?(?:\(dot\)|\[dot\]|\{dot\})[ ]?|[ ]dot[ ])"
_LABEL = r"[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+"
_DOMAIN = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})+", re.I)
_SPELT_DOT = re.compile(r"(?:\(dot\)|\[dot\]|\{dot\}|[ ]dot[ ])", re.I)

_SEP = r"(?:[ ]?[-–—./‑][ ]?|[ \xa0])?"
_PHONE = re.compile(rf"(?<![\w+])(?<![\d][-–./])(?:(?:\+1|001|1){_SEP})?(?:\([2-9]\d{{2}}\)|[2-9]\d{{2}}){_SEP}[2-9]\d{{2}}{_SEP}\d{{4}}(?![\w])(?![-–/.]\d)")

#: Numbers of other countries: a prefix with plus sign, then groups of digits.
_ABROAD = re.compile(r"(?<![\w+])\+[2-9]\d{0,2}(?:[ .\-–/]?(?:\(\d{1,5}\)|\d{1,5})){1,6}(?![\w])(?![-–/.]\d)")

_LABEL_GAP = r"[ \t\n]*"
_NUMBER_WORD = r"(?:(?:number|numbers|no|nr|num|número|numero|id|card|code)\b\.?|#)"
_ID_LABEL = {
    "ssn": re.compile(rf"(?:ssn|ss[ ]?#|social security|soc\.?[ ]?sec\.?|seguro social|id){_LABEL_GAP}{_NUMBER_WORD}?{_LABEL_GAP}(?:is|was|es)?[ ]*[:#=]?{_LABEL_GAP}", re.I),
    "medicare": re.compile(rf"(?:medicare|beneficiary|mbi|hicn){_LABEL_GAP}(?:beneficiary )?{_NUMBER_WORD}?{_LABEL_GAP}(?:is|was|es)?[ ]*[:#=]?{_LABEL_GAP}", re.I),
    "record": re.compile(rf"(?:mrn|medical record|chart|patient id|historia clínica|expediente){_LABEL_GAP}{_NUMBER_WORD}?(?: (?:of|for) the (?:patient|resident))?{_LABEL_GAP}(?:is|was|es)?[ ]*[:#=]?{_LABEL_GAP}", re.I),
    "license": re.compile(rf"(?:driver(?:['’]?s)?['’]? licen[cs]e|licen[cs]e of the driver|licencia(?: de conducir)?|dl){_LABEL_GAP}{_NUMBER_WORD}?{_LABEL_GAP}(?:is|was|es)?[ ]*[:#=]?{_LABEL_GAP}", re.I),
}
_ID_VALUE = {
    "ssn": re.compile(r"\d{3}([-–—. \xa0]?)\d{2}\1\d{4}(?![\w])(?![-–]\d)"),
    "medicare": re.compile(r"\d[A-Z][0-9A-Z]\d[- ]?[A-Z][0-9A-Z]\d[- ]?[A-Z]{2}\d{2}(?!\w)", re.I),
    "record": re.compile(r"[A-Z]{0,2}[-]?\d(?:[-]?\d){5,11}(?!\w)(?!-\d)", re.I),
    "license": re.compile(r"(?:[A-Z]{1,2}[- ]?\d{2,}(?:[- ]\d{2,})*|\d{7,12}|[A-Z]{1,2}\d{5,14})(?!\w)", re.I),
}

_UNIT = r"(?:(?:apt|apartment|suite|ste|unit|apto|floor|fl|bldg|building|depto)\b\.?[ ]?#?[ ]?(?:\d+[A-Za-z]?|[A-Za-z]\d*)(?![-\w])|#[ ]?\d+[A-Za-z]?(?![-\w]))"
_STATES = "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA PR RI SC SD TN TX UT VT VA WA WV WI WY".split()
_STATE = "(?:" + "|".join(_STATES) + ")"
_CITY = rf"(?:[ ]?[,\n][ \n]?[ ]?|[ ])(?:{_WORD}[ ]){{0,2}}{_WORD}\.?"
#: A city counts only with a state; a state without ZIP only behind a comma and in capitals ("in" and "or" are words).
_TAIL = re.compile(rf"(?:[ ]?,?[ \n]{_UNIT})?{_CITY}(?:,?[ ](?i:{_STATE})\b\.?,?[ ]\d{{5}}(?:-\d{{4}})?(?!\d)|,[ ](?-i:{_STATE})\b(?![ ]?\w))", re.I)
_UNIT_ONLY = re.compile(rf"[ ]?,?[ \n]{_UNIT}", re.I)
_DIRECTION = r"(?:(?:N|S|E|W|NE|NW|SE|SW|North|South|East|West|Northeast|Northwest|Southeast|Southwest)\.?[ ])"
#: What stands before a street word: house number, perhaps a direction, up to three words of the street's name.
_NUMBER = r"(?<![\w.,:/$#-])(?<!\d[ ])\d{1,6}(?:-?[A-Za-z])?(?:[ ]1/2)?[ ]"
_BEFORE_STREET = re.compile(rf"{_NUMBER}{_DIRECTION}?(?:(?:St|Mt|Ft)\.[ ]|{_WORD}[ ]|\d{{1,3}}(?:st|nd|rd|th)[ ]){{1,3}}\Z", re.I)
_CAPITAL = rf"(?:(?:de|del|la|las|los)[ ]|(?:Jr|Sr|St|Mt|Ft|{_L})\.[ ]|(?=[^\W\d_a-zß-öø-ÿ]){_WORD}[ ])"
#: The same with up to eight words and particles, all others in capitals.
_LONG_STREET = re.compile(rf"{_NUMBER}(?:[NSEW]{{1,2}}\.?[ ])?({_CAPITAL}{{1,8}})\Z")
_BEFORE_ROUTE = re.compile(rf"(?<![\w.,$#-])\d{{1,6}}(?:-?[A-Za-z])?[ ]{_DIRECTION}?(?:{_WORD}[ ])?\Z", re.I)
_ROUTES = frozenset(("county road", "route", "rural route", "state road", "highway", "hwy"))


def folded(text: str) -> str:
    """Lower case with one character for each character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(k := c.lower()) != 1 else k for c in text)


@functools.lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found: dict[str, list[tuple[str, str]]] = {}
    add = lambda word, kind, detail="": found.setdefault(word, []).append((kind, detail))
    for w in _AT:
        add(w, "at")
    for detail, words in _ID_CUES.items():
        for w in words:
            add(w, "id", detail)
    for w in _STREET_WORDS:
        add(w, "street")
    for w in _LEADING_STREETS:
        add(w, "leading")
    for w in _BOXES:
        add(w, "box")
    for w in _TITLES:
        add(w, "title")
    for w in _RELATIONS:
        add(w, "relation")
    for w in _LABELS:
        add(w, "label")
    for w in _AFTER:
        add(w, "after")
    for w in _GIVEN:
        add(w, "given")
    a = ahocorasick.Automaton()
    for w, kinds in found.items():
        a.add_word(w, (w, kinds))
    a.make_automaton()
    return a


def _letter(c: str) -> bool:
    return c.isalnum() or c == "_"


# ---- parsers: each returns (start, end) or None ----------------------------------------------------------------------


def _email(text: str, start: int, end: int, anchor: str) -> tuple[int, int] | None:
    left = start
    while left > 0 and text[left - 1] == " " and anchor != " at ":
        left -= 1
    if start - left > 1:
        return None
    first = left
    while first > 0 and _LOCAL_CHARACTER.match(text[first - 1]):
        first -= 1
    while first < left and text[first] in "._%+'-":
        first += 1
    if first == left or not _LOCAL_END.match(text[left - 1]):
        return None
    begin = end
    while begin < len(text) and text[begin] == " " and begin - end < 1:
        begin += 1
    domain = _DOMAIN.match(text, begin)
    if not domain:
        return None
    if anchor == " at " and not _SPELT_DOT.search(domain.group()):
        return None
    return first, domain.end()


def _identifier(text: str, start: int, detail: str) -> tuple[int, int] | None:
    label = _ID_LABEL[detail].match(text, start)
    if not label:
        return None
    value = _ID_VALUE[detail].match(text, label.end())
    if not value or (label.end() and _letter(text[label.end() - 1])):
        return None
    return value.span()


def _tail(text: str, at: int) -> int:
    """End of the unit, city, state and ZIP that directly follow."""
    if m := _TAIL.match(text, at):
        return m.end()
    if m := _UNIT_ONLY.match(text, at):
        return m.end()
    return at


_POINT = re.compile(r"\.(?=[ ,]?[ \n]?(?:[#\w]))")


def _street(text: str, low: str, start: int, end: int, word: str) -> tuple[int, int] | None:
    if word in _ROUTES:
        head = _BEFORE_ROUTE.search(text, max(0, start - 40), start)
        if not head or not (m := re.compile(r"[ ]\d{1,4}\b").match(text, end)):
            return None
        end = m.end()
    else:
        head = _BEFORE_STREET.search(text, max(0, start - 70), start)
    if not head or any(w in _STOP for w in re.findall(_WORD, low[head.start() : start]) if len(w) > 1):
        head = None if word in _ROUTES else _LONG_STREET.search(text, max(0, start - 160), start)
        if not head or any(w in _STOP and w not in _PARTICLES for w in head[1].lower().replace(".", "").split()):
            return None
    if text[end : end + 1] == "." and _POINT.match(text, end) and (_tail(text, end + 1) > end + 1):
        end += 1
    return head.start(), _tail(text, end)


_LEADING = re.compile(rf"[ ](?:(?:de|del|la|las|los|el)[ ]){{0,2}}{_WORD}(?:[ ]{_WORD})?,?[ ](?:#[ ]?)?\d{{1,6}}[A-Za-z]?(?!\w)", re.I)
_BOX = re.compile(r"[ ]#?[ ]?\d{1,7}(?!\w)")


def _leading(text: str, start: int, end: int) -> tuple[int, int] | None:
    m = _LEADING.match(text, end)
    return (start, _tail(text, m.end())) if m else None


def _box(text: str, start: int, end: int) -> tuple[int, int] | None:
    m = _BOX.match(text, end)
    return (start, _tail(text, m.end())) if m else None


_PARTICLE_RUN = re.compile(rf"[ ](?:(?:{'|'.join(sorted(_PARTICLES))})[ ]){{1,3}}(?={_L})", re.I)
_POSSESSIVE = re.compile("['’]s", re.I)


def _tokens(text: str, low: str, at: int, most: int = 4) -> list[tuple[int, int, bool]]:
    """Tokens of a name from ``at``: (start, end, is_initial), up to a stop word or a change of case.

    Particles join the words around them where these begin with capitals. Up to three words count, four where all are
    capitalised but not all in capitals, so that no sentence in one case is taken for a name.
    """
    out: list[tuple[int, int, bool]] = []
    while len(out) < most:
        m = _TOKEN.match(text, at)
        if not m:
            break
        initial = m.group(1) is not None
        s, e = m.span()
        if not initial and low[s:e] in _STOP:
            break
        full = [t for t in out if not t[2]]
        if full and not initial and text[full[0][0]].isupper() and not text[s].isupper():
            break
        out.append((s, e, initial))
        if text[s].isupper() and (p := _PARTICLE_RUN.match(text, e)):
            if text[p.end()].isupper() and (w := _TOKEN.match(text, p.end())) and low[w.start() : w.end()] not in _STOP:
                out[-1] = (s, w.end(), False)
                e = w.end()
        gap = _GAP.match(text, e)
        if not gap or "\n" in gap.group() and not (out and out[-1][2]):
            break
        at = gap.end()
    while out and out[-1][2]:  # a name does not end with an initial
        out.pop()
    if out and out[-1][1] - out[-1][0] > 3 and _POSSESSIVE.match(text, out[-1][1] - 2):
        out[-1] = (out[-1][0], out[-1][1] - 2, False)
    if sum(not t[2] for t in out) > 3 and not all(text[s].isupper() and (e - s == 1 or not text[s:e].isupper()) for s, e, _ in out):
        out = out[:3]
    return out


def _given_after_comma(text: str, low: str, end: int) -> int | None:
    """End of ', Given' or ', Given M.' right after a surname."""
    if text[end : end + 2] != ", ":
        return None
    m = re.compile(_WORD).match(text, end + 2)
    if not m or low[m.start() : m.end()] in _STOP or not m.group()[0].isalpha():
        return None
    stop = m.end()
    if i := re.compile(rf"[ ]({_L})\.").match(text, stop):
        stop = i.end()
    return stop


def _person(text: str, low: str, at: int, delimiter: str | None) -> tuple[int, int] | None:
    """A name that begins at ``at``; ``delimiter`` is a pattern of what must follow it, if anything."""
    toks = _tokens(text, low, at)
    if not toks:
        return None
    start, end = toks[0][0], toks[-1][1]
    follows = lambda e: delimiter is None or re.compile(delimiter, re.I).match(text, e)
    if len(toks) == 1:
        if delimiter is None:
            return start, end
        other = _given_after_comma(text, low, end)
        return (start, other) if other and follows(other) else None
    if follows(end):
        return start, end
    return None


_END_OF_NAME = r"[ ]*(?:[,;|(<:.\n]|$)|[ ]+(?:of|with|at|said|told|on|about|who|is|was|has|had|could|left|and|in|from|to|de|con|dijo|que|y)\b"


def _after_cue(text: str, low: str, end: int, kind: str) -> tuple[int, int] | None:
    if kind == "title":
        m = re.compile(r"\.?[ ]").match(text, end)
        return _person(text, low, m.end(), None) if m else None
    if kind == "relation":
        m = re.compile(r",[ ]").match(text, end) or re.compile(r"[ ]#?[A-Z]?\d{1,4}:[ ]").match(text, end)
        return _person(text, low, m.end(), r"[ ]*[,(;]") if m else None
    m = re.compile(r":?[ ]+").match(text, end)
    return _person(text, low, m.end(), _END_OF_NAME) if m else None


_BEFORE_AFTER = re.compile(rf"(?<![\w'’.-])(?:{_WORD},[ ]{_WORD}(?:[ ]{_L}\.)?|(?:{_WORD}|{_L}\.)(?:[ ]{_L}\.)?[ ]{_WORD})[ ]\Z")


_NEXT = re.compile(rf"(?:(?<=Jr)\.|(?<=Sr)\.)?(?:[ ](?:Jr|Sr|II|III)\b\.?)?((?:[ ](?=[^\W\d_a-zß-öø-ÿ]){_WORD}){{1,3}})")


def _plausible(text: str, span: tuple[int, int]) -> bool:
    """A name has words, none of them is a stop word, and no word of a place follows in capitals."""
    words = re.findall(_WORD, text[span[0] : span[1]])
    if not words or any(w.lower() in _STOP for w in words if len(w) > 1 and w.lower() not in _PARTICLES):
        return False
    after = None if text[span[0] : span[1]].isupper() else _NEXT.match(text, span[1])
    return not (after and any(w.lower() in _PLACES for w in after[1].split()))


_NAME_BEFORE = re.compile(rf"({_WORD})\.?[ ]\Z")


def _after_given(text: str, low: str, start: int, end: int) -> tuple[int, int] | None:
    """A common given name in capitals with the surname that follows it: 'John Smith', 'Maria J. Lopez de Soto'."""
    if not text[start].isupper() or text[start:end].isupper():
        return None
    before = _NAME_BEFORE.search(text, max(0, start - 40), start)
    if before and (before[1].lower() in _BEFORE_PLACE or (before[1][0].isupper() and before[1].lower() in _PLACES)):
        return None
    toks = _tokens(text, low, start)
    full = [low[s:e] for s, e, initial in toks if not initial]
    if len(full) < 2 or any(w in _PLACES for w in full) or not all(text[s].isupper() for s, _, _ in toks):
        return None
    return toks[0][0], toks[-1][1]


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(type, start, end) of each occurrence, in code points, in order and without overlaps."""
    if not text:
        return []
    low = folded(text)
    hits: set[tuple[int, int, str]] = set()
    n = len(text)
    for m in _PHONE.finditer(text):
        hits.add((m.start(), m.end(), PHONE))
    for m in _ABROAD.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            hits.add((m.start(), m.end(), PHONE))
    for last, (word, kinds) in _automaton().iter(low):
        end = last + 1
        start = end - len(word)
        whole = (start == 0 or not _letter(low[start - 1])) and (end == n or not _letter(low[end]))
        for kind, detail in kinds:
            span, label = None, NAME
            if kind == "at":
                span, label = _email(text, start, end, word), EMAIL
            elif kind == "id":
                if (start == 0 or not _letter(low[start - 1])) and (end == n or not low[end].isalpha() or detail == "license"):
                    span, label = _identifier(text, start, detail), ID_NUMBER
            elif not whole:
                continue
            elif kind == "street":
                span, label = _street(text, low, start, end, word), ADDRESS
            elif kind == "leading":
                span, label = _leading(text, start, end), ADDRESS
            elif kind == "box":
                span, label = _box(text, start, end), ADDRESS
            elif kind == "given":
                span = _after_given(text, low, start, end)
            elif kind == "after":
                if m := _BEFORE_AFTER.search(text, max(0, start - 60), start):
                    span = (m.start(), m.end() - 1)
            else:
                span = _after_cue(text, low, end, kind)
            if span and (label != NAME or _plausible(text, span)):
                hits.add((*span, label))
    starts: list[int] = []  # of the occurrences taken so far, in order
    taken: list[tuple[int, int, str]] = []
    for s, e, label in sorted(hits, key=lambda h: (_RANK[h[2]], -(h[1] - h[0]), h[0])):
        k = bisect.bisect_right(starts, s)
        if (k == 0 or taken[k - 1][1] <= s) and (k == len(taken) or taken[k][0] >= e):
            starts.insert(k, s)
            taken.insert(k, (s, e, label))
    return [(label, s, e) for s, e, label in taken]


def redact(text: str | None) -> str | None:
    """The text with each occurrence replaced by a placeholder of its type, the rest unchanged; null stays null."""
    if text is None:
        return None
    out, at = [], 0
    for label, s, e in find(text):
        out += [text[at:s], f"[{label}]"]
        at = e
    return "".join(out) + text[at:]


def occurrences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pii_type, start_pos, end_pos): one row per occurrence; null and empty texts have none."""
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, which = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                here = find(t)
                rows += here
                which += [i] * len(here)
            types, starts, ends = zip(*rows) if rows else ((), (), ())
            arrays = [batch.column(0).take(pa.array(which, pa.int64())), pa.array(types, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "pii_type", "start_pos", "end_pos"])

    return narrow.mapInArrow(work, f"`{key}` {kind}, pii_type string, start_pos bigint, end_pos bigint")


def redacted(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): every text with typed placeholders; null stays null, one row per input row."""
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([redact(t) for t in batch.column(1).to_pylist()], pa.string())], names=[key, "text"])

    return narrow.mapInArrow(work, f"`{key}` {kind}, text string")
