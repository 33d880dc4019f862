"""Personal information in free text: find it, and replace it with typed placeholders.

Anchor expansion. One Aho-Corasick pass over the lower-cased text finds anchors: at-signs and ways to write them, identifier
cues, street words, digits and spelled digits, given names, titles, initials and words for a person's part. From each anchor a
local parser expands to the left and right, as far as the piece goes, and validates it; text away from anchors is never
looked at. Pieces are settled in the order e-mail, identity number, address, phone, name; a later one never takes
characters of an earlier.

A name is a given name and a surname, an initial and a surname, or a title and a surname. Given names come from a lexicon that
the caller passes (``given_names`` reads one from a table of users); there is no list of surnames. A surname is any word that
its context doesn't speak against: capitalised where the text has capitals; where given name and surname are all in small
letters or all in capitals, a word that is no single entry of a public vocabulary, which holds the ordinary words of a language.
So ordinary words as surnames ("anna baker" in small letters) aren't found. Where the vocabulary can't be read the query fails,
rather than find fewer names.

Whole texts are read, of any length. Null and empty texts hold no
case. The same text in two deliveries of a review gives the same pieces, which count once.
"""

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encode import TOKENIZERS, VOCABULARY, encoder
from tidemark.session import spread

# Common given names, titles, street words and other words that the parsers know.
GIVEN_NAMES = (
    "aaron adam alan albert alejandro alex alexander alice amanda amy ana andrea andrew angela anna anne anthony antonio ashley "
    "barbara benjamin beth betty brandon brenda brian bruce carl carlos carol caroline catherine charles chris christian "
    "christina christine christopher cynthia daniel david deborah dennis diana diane diego donald donna dorothy douglas "
    "edward elena elizabeth emily emma eric erik ethan eva evelyn fatima fernando francisco gary george gerald gregory hannah "
    "hans harold heather helen henry ian isabel jacob james jason javier jean jeff jeffrey jennifer jeremy jessica joan john "
    "johannes jonathan jorge jose joseph josé joshua joyce juan judith julia julie justin karen katherine kathleen katie keith "
    "kelly kenneth kevin kim kimberly kyle larry laura lauren lawrence linda lisa louis lucas luis luke margaret maria marie "
    "marilyn martha martin mary maría matthew megan melissa michael michelle miguel mike mohamed mohammed nancy natalie nathan "
    "nicholas nicole nina olivia oscar pamela patricia patrick paul pedro peter philip pierre rachel ralph raymond rebecca "
    "richard robert roger ronald roy russell ruth ryan samantha samuel sandra sara sarah scott sean sharon sofia sophia sophie "
    "stefan stephanie stephen steven susan teresa theresa thomas tim timothy tina tyler victor victoria vincent virginia "
    "walter wayne william zachary"
).split()
TITLES = "mr mrs ms miss mx dr prof sir madam herr frau señor señora monsieur madame mme".split()
STREET_WORDS = (
    "street st avenue ave road rd boulevard blvd lane ln drive dr court ct way place pl terrace ter circle cir square sq "
    "parkway pkwy highway hwy trail trl row crescent close"
).split()
NOT_IN_STREET = frozenset(
    "a an and at away blocks block by down feet for from hours in into just km m meters miles mile min minutes of off on "
    "onto or our over per percent the their to up was we were with you".split()
)
# Capitalised words that open sentences or name days, months, places to go and firms rather than persons.
NOT_A_NAME = frozenset(
    "a an and are as at but by did do does for from had has have he her hers him his i in is it its my no not of on or our said she so that the "
    "their them then they this to was we were when who will with you your after again all also always although am another any anyway around ask because "
    "been before being best both bring came can come could definitely despite down each either even every everyone everything few fine first food get go "
    "good got great how however if instead just last later less let like look many maybe me more most much near nearly never next nice nobody nope nothing "
    "now oh ok okay once one only other otherwise out over overall per perhaps please plus really same see several should since skip some someone "
    "sometimes soon still sure take than thank thanks there these those though til today tomorrow tonight too totally try two under unfortunately until up "
    "very well went what whatever where which while why wish within without worth would yes yet you'll i'm i've it's don't that's we're we've "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october "
    "november december christmas easter new north south east west hotel restaurant bakery diner bistro grill grille room hall hill park kitchen market salon "
    "house bar clinic corner cafe shop works square plaza center centre mall airport station school hospital church city beach creek river lake bridge street "
    "avenue road drive lane place inc llc co ltd der die das los las il".split()
)
NOT_A_PERSON = frozenset(
    "dr pepper,mr pibb,mr clean,mr coffee,mr bean,mr goodcents,mrs butterworth,mrs butterworths,mrs fields,ms pacman,ms office,miss saigon,miss piggy,"
    "miss america,miss universe,sir mix,prof plum,tom collins,shirley temple,arnold palmer,jack daniels,johnnie walker,"
    "james bond,mary jane,jean georges,virginia beach,victoria secret,victoria station,victoria secrets,victoria falls,virginia tech,"
    "virginia ham,maria cookies,christian louboutin,george foreman,roy rogers,caesar salad,michael kors,diego rivera".split(",")
)
NOT_INITIALS = frozenset("us uk la dc ny nyc ps am pm eu un usa nw ne sw se tv id vs bbq rsvp".split())
PERSON_CUES = (
    "server waiter waitress manager owner chef bartender host hostess cashier technician mechanic stylist dentist doctor nurse "
    "realtor agent receptionist supervisor employee named"
).split()
IDENTITY_CUES = (
    "social security number", "social security", "ssn", "soc sec", "soc. sec.", "social", "tax id", "tax number", "tin", "itin", "national id",
    "national insurance number", "national insurance", "ni number", "nino", "dni", "nie", "identity number", "identity card",
    "id number", "id card", "passport number", "passport no", "passport", "driver's license", "driver's licence",
    "drivers license", "driving licence", "license number", "licence number", "license no", "licence no", "license",
    "licence", "dl",
)
NOT_PHONE_CUES = ("order", "invoice", "inv-", "coupon", "card", "confirmation", "receipt", "ticket", "tracking", "model", "code")
SPELLED_DIGITS = "zero oh one two three four five six seven eight nine".split()

_SEP = r"[\s.\-‐-―]"
_PHONE = re.compile(
    rf"""(?<![\w$€£+\-/.])(?:
      \+\d{{1,3}}{_SEP}?\(?\d{{1,4}}\)?(?:{_SEP}?\d{{2,4}}){{2,4}}
    | (?:1{_SEP}?)?\(\d{{3}}\){_SEP}?\d{{3}}{_SEP}?\d{{4}}
    | (?:1{_SEP})?[2-9]\d{{2}}{_SEP}\d{{3}}{_SEP}\d{{4}}
    | 1?[2-9]\d{{9}}
    | 0\d{{1,4}}(?:\s?[/.\-]\s?|\s)\d{{2,8}}(?:{_SEP}\d{{2,5}}){{0,4}}
    )(?![\w]|-\d)(?:,?\s*(?:ext|x)\.?\s?\d{{1,5}}\b)?""",
    re.X | re.I,
)
_WORD_PHONE = re.compile(rf"(?i)(?<!\w)(?:(?:{'|'.join(SPELLED_DIGITS)})[\s,\-]+){{6,}}(?:{'|'.join(SPELLED_DIGITS)})(?!\w)")
_ID_VALUE = re.compile(
    r"""(?ix)(?<!\w)(?:
      [a-z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[a-z]
    | [a-z]\d{3}[-\s]\d{4}[-\s]\d{4}
    | \d{3}[-\s]?\d{2}[-\s]?\d{4}
    | [a-z]{1,3}[-\s]?\d{6,10}
    | \d{7,12}[-\s]?[a-z]?
    )(?!\w)"""
)
_ID_GLUE = re.compile(r"(?i)(?:[\s:,;(#'’\"*]|\bis\b|\bwas\b|\bno\b\.?|\bnumber\b|\bnr\b\.?|\bnum\b\.?)*")
_BARE_SSN = re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.%+-")
_DOMAIN = re.compile(r"(?i)[a-z0-9\-]+(?:(?:\.|\s+dot\s+|\s?[(\[]dot[)\]]\s?)[a-z0-9\-]+)+")
_UNIT = r"(?:,?\s*(?:(?:apt|apartment|suite|ste|unit|flat|floor|fl|room)\b\.?\s*\#?|\#)\s*\d*[A-Za-z]?\d*\b)?"
_STREET = re.compile(
    rf"""(?ix)(?<![\w$€£.,\-/\#:])\d{{1,5}}[a-z]?\s+
      (?:(?:north|south|east|west|[nsew])\.?\s+)?
      (?P<name>[^\W\d_][\w'’\-]*(?:\s+[^\W\d_][\w'’\-]*){{0,3}}?)\s+
      (?:{'|'.join(STREET_WORDS)})(?!\w)\.?{_UNIT}"""
)
_RUE = re.compile(
    rf"""(?ix)(?<![\w$€£.,\-/\#:])\d{{1,4}}(?:\s?(?:bis|ter|[a-d]))?,?\s+(?:rue|avenue|boulevard|place|chemin|quai|all[ée]e|impasse)\s+
      (?:(?:de|du|des|la|le|les)\s+|d['’]|l['’])*[^\W\d_][\w'’\-]*{_UNIT}"""
)
_STRASSE = re.compile(r"(?i)(?<!\w)[^\W\d_][\w\-]*(?:stra(?:ß|ss)e|str\.|weg|platz|allee|gasse|damm|ufer)\s+\d{1,4}(?:\s?[a-z]\b)?(?![\w.]\d)")
_CALLE = re.compile(r"(?i)(?<!\w)(?:calle|avenida|plaza|paseo|camino)\s+(?:(?:de|del|la|el|los|las)\s+)*[^\W\d_][\w'’\-]*,?\s+(?:n[ºo°]\.?\s*)?\d{1,4}(?!\w)")
_CAP = r"[^\W\d_a-zß-ÿ][\w'’]*(?:-[^\W\d_]\w*)*"
_NAME = r"[^\W\d_][\w'’]*(?:-[^\W\d_]\w*)*"
_PARTICLE = r"(?:(?:van|von|de|del|della|di|da|dos|du|la|le|der|den|ten|ter|bin|ibn|al|el|st\.?)[^\S\n]+){0,3}"
_AFTER_GIVEN = re.compile(rf"(?i)[^\S\n]+(?:(?P<middle>[^\W\d_]\.)[^\S\n]+)?(?P<last>{_PARTICLE}{_NAME})")
_AFTER_TITLE = re.compile(rf"(?i)\.?[^\S\n]+(?P<more>(?:(?:[^\W\d_]\.[^\S\n]*){{1,2}})?)(?P<last>{_PARTICLE}{_NAME})(?:[^\S\n]+(?P<second>{_PARTICLE}{_NAME}))?")
_AFTER_INITIAL = re.compile(rf"(?i)(?:[^\S\n]?[^\W\d_]\.)*[^\S\n]?(?P<last>{_PARTICLE}{_NAME})(?![@\w])")
_AFTER_PART = re.compile(rf"(?:,|:|[^\S\n]+was|[^\S\n]+is)?[^\S\n]+(?P<first>{_CAP})[^\S\n]+(?:[A-Z]\.[^\S\n]+)?(?P<last>{_PARTICLE}{_CAP})(?![@\w])")
# words after which a place or an event comes rather than a person
_TO_A_PLACE = frozenset("at in from near inside outside around through behind past via of off after before since until unlike visit visiting visited leaving".split())
_TO_A_PERSON = frozenset("by to with for against is was named signed dear contact beside like out birthday owner manager server".split())


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Finder:
    """The automaton and parsers of one process; made once per Python worker. ``known`` tells ordinary words (their entries in
    a public vocabulary); None takes every word for an ordinary one."""

    def __init__(self, given: Iterable[str] = GIVEN_NAMES, known=None):
        import ahocorasick

        self.given = frozenset(g.lower() for g in given)
        self.known = known
        self.plain: dict[str, bool] = {}
        auto = ahocorasick.Automaton()
        for kind, words in (
            ("E", ("@", "(at)", "[at]", "{at}", "( at )", "[ at ]", " at ")), ("I", IDENTITY_CUES), ("A", [f" {w}" for w in STREET_WORDS]),
            ("R", ("rue", "chemin", "quai", "impasse", "allée", "allee", "avenue", "boulevard", "place")), ("G", ("straße", "strasse", "str.", "weg", "platz", "allee", "gasse", "damm", "ufer")),
            ("C", ("calle", "avenida", "plaza", "paseo", "camino")), ("N", "0123456789"), ("W", SPELLED_DIGITS), ("F", self.given), ("T", TITLES), ("L", (".",)), ("P", PERSON_CUES),
        ):
            for w in words:
                auto.add_word(w, (*auto.get(w, ()), (kind, len(w))))
        auto.make_automaton()
        self.auto = auto

    def find(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, kind) of every piece, in order of place."""
        if not text:
            return []
        low = _lower(text)
        hits: dict[str, list[tuple[int, int]]] = {}
        for end, kinds in self.auto.iter(low):
            for kind, size in kinds:
                hits.setdefault(kind, []).append((end + 1 - size, end + 1))
        out: list[tuple[int, int, str]] = []

        def add(a: int, b: int, kind: str) -> bool:
            if any(a < y and x < b for x, y, _ in out):
                return False
            out.append((a, b, kind))
            return True

        runs = [a for a, _ in hits.get("N", ()) if not a or not low[a - 1].isdigit()]
        self._emails(text, low, hits.get("E", ()), add)
        self._ids(text, low, hits.get("I", ()), runs, add)
        self._addresses(text, hits, add)
        self._phones(text, low, runs, hits.get("W", ()), add)
        self._names(text, low, hits, add)
        out.sort()
        return out

    @staticmethod
    def _cued(low: str, at: int) -> bool:
        """Is the number one of an order, an invoice, a card and so on? One of the four words before it in its sentence says so;
        other numbers of the same row of digits and "no." don't count as words."""
        i, words = at, 0
        while words < 4:
            while i and low[i - 1] in " #:(\"'-":
                i -= 1
            j = i
            while j and not low[j - 1].isspace() and low[j - 1] not in "(>":
                j -= 1
            word = low[j:i]
            if not word or (word[-1] in ".!?" and word not in ("no.", "nr.", "num.")):
                return False
            if word.startswith(NOT_PHONE_CUES):
                return True
            words += not (word.strip(".-").isdigit() or word in ("no.", "nr.", "num."))
            i = j
        return False

    @staticmethod
    def _emails(text: str, low: str, hits, add) -> None:
        for a, b in hits:
            spelled = low[a:b] == " at "
            i = a - 1 if not spelled and a and text[a - 1].isspace() else a
            while True:
                start = i
                while start and text[start - 1] in _LOCAL:
                    start -= 1
                while start < i and text[start] == ".":
                    start += 1
                word = start
                while word and text[word - 1].isspace():
                    word -= 1
                # another word before a spelled dot
                if start < i and word < start and low.endswith(" dot", 0, word) and word > 4:
                    i = word - 4
                    while i and text[i - 1].isspace():
                        i -= 1
                    continue
                break
            if start == i or (start and (text[start - 1].isalnum() or text[start - 1] in "@_")) or text[i - 1] == ".":
                continue
            m = _DOMAIN.match(text, b + (not spelled and text[b : b + 1].isspace()))
            if m and (not spelled or re.search(r"(?i)\sdot\s", m.group())):
                add(start, m.end(), "EMAIL")

    @staticmethod
    def _ids(text: str, low: str, cues, runs, add) -> None:
        taken = -1
        for a, b in sorted(cues, key=lambda x: (x[0], -x[1])):
            if a < taken or (a and (low[a - 1].isalnum())) or (b < len(low) and low[b].isalnum()):
                continue
            m = _ID_VALUE.match(text, _ID_GLUE.match(text, b).end())
            if m and add(*m.span(), "ID"):
                taken = m.end()
        for a in runs:
            m = _BARE_SSN.match(text, a)
            if m and not Finder._cued(low, a):
                add(*m.span(), "ID")

    @staticmethod
    def _addresses(text: str, hits, add) -> None:
        def back(i: int, words: int) -> Iterator[int]:
            """Starts of the words before a place, from near to far."""
            for _ in range(words):
                while i and text[i - 1].isspace():
                    i -= 1
                j = i
                while j and not text[j - 1].isspace() and (text[j - 1] != ">" or j == i):
                    j -= 1
                if j == i:
                    return
                i = j
                while j < len(text) and not text[j].isalnum() and text[j] not in "$€£.,-/#:":
                    j += 1
                yield j

        for a, b in hits.get("A", ()):
            if b < len(text) and (text[b].isalnum() or text[b] == "_"):
                continue
            for at in back(a, 6):
                m = _STREET.match(text, at) if text[at : at + 1].isdigit() else None
                if m and m.end() >= b:
                    if NOT_IN_STREET.isdisjoint(m["name"].lower().split()):
                        add(*m.span(), "ADDRESS")
                    break
        for a, _ in hits.get("R", ()):
            for at in back(a, 2):
                m = _RUE.match(text, at) if text[at : at + 1].isdigit() else None
                if m and m.end() > a:
                    add(*m.span(), "ADDRESS")
                    break
        for a, b in hits.get("G", ()):
            while a and (text[a - 1].isalnum() or text[a - 1] in "_-"):
                a -= 1
            m = _STRASSE.match(text, a)
            if m and m.end() > b:
                add(*m.span(), "ADDRESS")
        for a, _ in hits.get("C", ()):
            if m := _CALLE.match(text, a):
                add(*m.span(), "ADDRESS")

    @staticmethod
    def _phones(text: str, low: str, runs, spelled, add) -> None:
        done = -1
        for a in runs:
            if a < done:
                continue
            at = a
            while at and text[at - 1] in "+(":
                at -= 1
            for begin in dict.fromkeys((at, a)):
                m = _PHONE.match(text, begin)
                if m and 9 <= sum(map(str.isdigit, re.split(r"(?i)ext|x", m.group())[0])) <= 13:
                    if not Finder._cued(low, begin):
                        add(*m.span(), "PHONE")
                    done = m.end()
                    break
        done = -1
        for a, _ in spelled:
            if a >= done and (m := _WORD_PHONE.match(text, a)):
                add(*m.span(), "PHONE")
                done = m.end()

    def _ordinary(self, word: str) -> bool:
        """Is every part of the word an entry of the vocabulary?"""
        got = self.plain.get(word)
        if got is None:
            if len(self.plain) > 1 << 18:
                self.plain.clear()
            parts = [p for p in re.split(r"[-'’]", word.lower()) if p]
            got = self.plain[word] = self.known is None or all(len(p) < 4 or (" " + p).encode() in self.known for p in parts)
        return got

    def _surname(self, last: str, first: str, text: str, end: int) -> bool:
        """May ``last`` be a surname beside ``first``? Checks letter case, ordinary words and what follows."""
        core = re.sub(r"['’][sS]$", "", last.split()[-1])
        plain = core.lower()
        if len(plain) < 2 or plain in NOT_A_NAME or plain in self.given and len(last.split()) == 1 or plain in TITLES:
            return False
        after = re.compile(r"[^\S\n]+([^\W\d_]+)").match(text, end)
        if after and after[1].lower() in STREET_WORDS and after[1][:1].isupper():
            return False
        if core[0].isupper() and not (core.isupper() and len(core) > 1 and not first.isupper()):
            return not (core.isupper() and len(core) > 1) or not self._ordinary(core)
        return (first.islower() or first.isupper()) and not self._ordinary(core)

    def _names(self, text: str, low: str, hits, add) -> None:
        def whole(a: int, b: int) -> bool:
            return not (a and (low[a - 1].isalnum() or low[a - 1] in "-'’_@.&*")) and not (b < len(low) and (low[b].isalnum() or low[b] in "-_@"))

        def put(a: int, m: re.Match) -> bool:
            last = m["last"]
            return add(a, m.end("last") - (2 if last[-2:].lower() in ("'s", "’s") else 0), "NAME")

        def word_before(i: int) -> tuple[int, str]:
            """Start and text of the word, with particles, that ends at ``i``."""
            j = i
            while j and (low[j - 1].isalnum() or low[j - 1] in "-'’"):
                j -= 1
            start = j
            while True:
                k = start
                while k and low[k - 1] == " ":
                    k -= 1
                h = k
                while h and low[h - 1].isalpha():
                    h -= 1
                if k == start or not re.fullmatch(_PARTICLE, low[h:k] + " "):
                    return start, text[start:i]
                start = h

        for a, b in sorted(hits.get("T", ()), key=lambda x: (x[0], -x[1])):
            m = _AFTER_TITLE.match(text, b) if whole(a, b) or (whole(a, b + 1) and low[b : b + 1] == ".") else None
            if not m:
                continue
            title, last = text[a:b], m["last"]
            if not title[0].isupper() and not (text[b : b + 1] == "." or title in ("mr", "mrs", "ms", "dr", "prof")):
                continue
            small = not last.split()[-1][0].isupper()
            if small and low[a:b] not in ("mr", "mrs", "ms") and self._ordinary(last.split()[-1]):
                continue
            if f"{low[a:b]} {re.sub(r"['’]s?$", '', last.lower())}" in NOT_A_PERSON:
                continue
            case = last if not small else "a"
            second = m["second"]
            if second and last[:1].isupper() and second.split()[-1][:1].isupper() and self._surname(second, last, text, m.end("second")):
                add(a, m.end("second") - (2 if second[-2:].lower() in ("'s", "’s") else 0), "NAME")
            elif last.lower() not in NOT_A_NAME and (self._surname(last, case, text, m.end("last")) or small or last.lower() in self.given):
                put(a, m)
        for a, b in sorted(hits.get("F", ()), key=lambda x: (x[0], -x[1])):
            if not whole(a, b):
                continue
            first = text[a:b]
            m = _AFTER_GIVEN.match(text, b)
            if m and f"{low[a:b]} {m['last'].lower()}" not in NOT_A_PERSON and self._surname(m["last"], first, text, m.end("last")) and low[m.end() : m.end() + 1] != "@":
                put(a, m)
                continue
            # surname first
            i = a
            while i and low[i - 1] == " ":
                i -= 1
            if i < a and i and low[i - 1] == ",":
                start, last = word_before(i - 1)
                before = word_before(len(text[:start].rstrip()))[1].lower().split()[-1:]
                told = not before or before[0] in _TO_A_PERSON
                if last and (told or not self._ordinary(last) and not (self.known and (" " + last).encode() in self.known) and before[0] not in _TO_A_PLACE) and not (start and low[start - 1] in "@*&") and self._surname(last, first, text, i - 1):
                    middle = re.compile(r" [A-Z]\.").match(text, b)
                    add(start, middle.end() if middle else b, "NAME")
        for a, b in hits.get("L", ()):
            # an initial: one letter before the stop, none before that
            i = a - 1
            if i < 0 or not low[i].isalpha() or (i and (low[i - 1].isalnum() or low[i - 1] in "@&*'’_.")):
                continue
            letter, m = text[i], _AFTER_INITIAL.match(text, b)
            if m and (letter.isupper() or letter.islower() and m["last"].islower()) and re.sub(r"[\W]", "", low[i : m.start("last")]) not in NOT_INITIALS:
                if not (m["last"].isupper() and len(m["last"]) < 4) and self._surname(m["last"], "A" if m["last"].isupper() else letter.lower() if m["last"].islower() else "Aa", text, m.end("last")):
                    put(i, m)
                    continue
            if i > 1 and low[i - 1] == " " and low[i - 2] == ",":
                start, last = word_before(i - 2)
                before = word_before(len(text[:start].rstrip()))[1].lower().split()[-1:]
                if last[:1].isupper() and letter.isupper() and (not before or before[0] in _TO_A_PERSON) and self._surname(last, "Aa", text, i - 2):
                    add(start, b, "NAME")
        for a, b in hits.get("P", ()):
            m = _AFTER_PART.match(text, b) if whole(a, b) or low[b : b + 1] in ",:" else None
            if m and m["first"].lower() not in NOT_A_NAME and m["first"][1:].islower() and f"{m['first']} {m['last']}".lower() not in NOT_A_PERSON and self._surname(m["last"], m["first"], text, m.end("last")):
                put(m.start("first"), m)


@lru_cache(4)
def _finder(given: tuple[str, ...], folder: str, vocabulary: str) -> Finder:
    return Finder(given, encoder(folder, vocabulary).ranks)


def given_names(users: DataFrame, name: str, least: int = 2) -> tuple[str, ...]:
    """A lexicon from a column of users' names: all first words that at least ``least`` users have, and the common names. Names
    of users, not their texts, are all that is read. A column that isn't of strings holds no names and raises."""
    kind = users.select(F.col(f"`{name}`")).schema[0].dataType.simpleString()
    if not kind.startswith(("string", "varchar", "char")):
        raise TypeError(f"names are strings, {name} is {kind}")
    first = F.lower(F.regexp_extract(F.col(f"`{name}`"), r"^\s*(\p{L}[\p{L}\p{M}'’\-]+)", 1))
    counts = users.select(first.alias("n")).filter(F.length("n") > 1).groupBy("n").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= least)
    return tuple(sorted({r["n"] for r in counts.select("n").collect()} | set(GIVEN_NAMES)))


def find_pii(df: DataFrame, key: str, text: str, given=GIVEN_NAMES, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row ``(key, kind, occ)`` per piece; ``occ`` counts the pieces of a kind within a text from 1.

    Map-only up to the pieces, which are few; only these are made distinct, so texts are never shuffled
    to find repeated deliveries. Rows with a null key are left out.
    """
    names = (tuple(given), folder, vocabulary)
    kind = df.schema[key].dataType.simpleString()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(*names).find
        for batch in batches:
            row: list[int] = []
            kinds: list[str] = []
            occ: list[int] = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                count: dict[str, int] = {}
                for _, _, k in find(t):
                    count[k] = count.get(k, 0) + 1
                    row.append(i)
                    kinds.append(k)
                    occ.append(count[k])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(kinds, pa.string()), pa.array(occ, pa.int64())], [key, "kind", "occ"])

    narrow = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("__text")).filter(F.col(key).isNotNull() & (F.length("__text") > 0))
    return spread(narrow).mapInArrow(scan, f"`{key}` {kind}, kind string, occ bigint").distinct()


def redact(text: Column, given=GIVEN_NAMES, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """The text with every piece replaced by ``[EMAIL]``, ``[PHONE]``, ``[ID]``, ``[ADDRESS]`` or ``[NAME]``.
    Null stays null; texts without a case come back unchanged."""
    names = (tuple(given), folder, vocabulary)

    @F.pandas_udf("string")
    def _redact(s: pd.Series) -> pd.Series:
        find = _finder(*names).find

        def one(t):
            if t is None:
                return None
            parts, last = [], 0
            for a, b, k in find(t):
                parts += [t[last:a], f"[{k}]"]
                last = b
            return "".join(parts) + t[last:] if parts else t

        return s.map(one)

    return _redact(text)


