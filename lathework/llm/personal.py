"""Problem 4: personal information in free text, found and replaced by typed placeholders."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from lathework.functions.batches import map_columns
from lathework.llm.residue_seeds import PROSE

KINDS = ("email", "phone", "id_number", "address", "name")

# --- Anchors ----------------------------------------------------------------------------------

# Common given names, one feature of a name among others.
GIVEN_NAMES = (
    "Aaron Adam Adrian Ahmed Aisha Alan Alba Alejandro Alex Alexander Alice Amara Amina Amy Ana Anders Andrea Andreas Andrei Andrew Angela Anita Anja Anna Anne Anton Antonio Arthur Astrid "
    "Barbara Beatriz Ben Benjamin Bernd Birgit Björn Bruno Camille Carla Carlos Carmen Caroline Charles Charlotte Chen Chiara Chloe Chloé Christian Christine Claire Clara Claudia Daniel Daniela David "
    "Deborah Diana Diego Dieter Dirk Dmitri Edward Elena Elias Elisa Elizabeth Ella Ellen Emil Emily Emma Eric Erik Ethan Eva Fatima Felix Fernando Florian Francisco Frank François Gabriel Georg George "
    "Giulia Greta Hana Hanna Hannah Hans Heike Helen Helena Henrik Henry Hiroshi Hugo Ian Ibrahim Ines Ingrid Irene Isabel Ivan Jack Jakob James Jan Jane Javier Jean Jennifer Jens Joan Johan Johanna John "
    "Jonas Jorge José Juan Julia Julian Jürgen Karin Karl Katarina Katja Kevin Klaus Kofi Laura Leila Lena Leo Leon Liam Linda Lisa Louis Luca Lucas Lucía Luis Luisa Lukas Magnus Manuel Marco Marcus Maria "
    "María Marie Mark Markus Marta Martin Mary Mateo Matteo Matthias Max Mei Mia Michael Miguel Mohammed Monica Nadia Nina Niklas Noah Nora Olga Oliver Olivia Omar Oscar Pablo Patricia Paul Paula Pedro "
    "Petra Peter Philip Pierre Priya Rachel Rafael Ralf Ravi Richard Robert Rohan Rosa Ruth Samuel Sandra Sara Sarah Sebastian Simon Sofia Sofía Sophie Stefan Stephen Susan Susanne Sven Teresa Theo Thomas "
    "Tim Tobias Tom Tomas Ursula Uwe Valentina Vera Victor Viktor Walter Wei Wolfgang Yasmin Yuki Yusuf Zoe"
).split()
# Titles before a family name.
TITLES = "Mr Mrs Ms Miss Mx Dr Prof Sir Herr Herrn Frau Monsieur Madame Mme Mlle M Sr Sra Srta Señor Señora Don Doña Dott".split()
# Family names of several regions, from which the letters of names are learnt.
FAMILY_NAMES = (
    "Smith Johnson Williams Brown Taylor Davies Evans Murphy Kelly OBrien Walsh Campbell Stewart Anderson Andersen Nilsson Larsen Johansson Virtanen Müller Schneider Fischer Weber Wagner Becker "
    "Hoffmann Schäfer Dubois Laurent Lefebvre Moreau Fournier García Martínez López Sánchez Fernández Rodríguez Silva Santos Oliveira Rossi Ferrari Esposito Bianchi Kowalski Nowak Novák Horvat "
    "Ivanov Petrov Sokolov Papadopoulos Yılmaz Demir Kaya Haddad Nasser Hosseini Khan Ahmed Hussain Patel Sharma Gupta Reddy Nair Perera Nguyen Tran Pham Wang Zhang Chen Liu Tanaka Suzuki "
    "Takahashi Watanabe Kim Park Choi Okafor Adeyemi Mensah Boateng Khumalo Dlamini Nkosi Mwangi Otieno Abebe Traoré Diallo Gonçalves Costa Vargas Mendoza Castillo Quispe Mamani"
).split()
# What stands before a person, after a person, and words that are in no person's name.
BEFORE_NAMES = (
    "colleague |opened by |maintained by |reported by |written by |co-written with |approved by |reviewed by |assigned to |owned by |signed by |name is |named |called |name=|name: |name\": \"|customer\": \"|author\": \"|author: |"
    "author |owner: |contact: |contact : |contact |ask |asked |regards, |thanks, |thanks! -- |cheers, |best, |-- |dear |hi |hello |signed-off-by: |co-authored-by: |cc |attn |attention of |spoke to |spoke with |talk to |met |"
    "i am |i'm |my name's |customer |patient |employee |tenant |manager |engineer |teacher |neighbour |friend |kollege |kollegin |ansprechpartner: |ansprechpartnerin: |grüße, |geehrter |geehrte |liebe |lieber |heiße |namens |frag |"
    "collègue |cordialement, |bonjour |m'appelle |contacter |demandez à |compañero |compañera |contacto: |llamo |saludos, |estimado |estimada |pregunte a |"
).split("|")[:-1]
AFTER_NAMES = " said| says| wrote| writes| asked| called| told| will call| will reply| joined| left the| reported| confirmed| replied| emailed| phoned| signed| lives| works| was born| has asked| sagte| schrieb| arbeitet| wohnt| a dit| habite| travaille| dijo| escribió| vive| trabaja".split("|")
NO_NAME_WORDS = frozenset(
    "the this that these those our your their his her its my all any some every each no new old best last next first please thanks hello dear hi best kind regards note warning error server service services system cluster "
    "node nodes team teams group project product platform cloud store storage database queue worker event events stream release rollout rollouts version update upgrade build test tests code data file files page docs "
    "support desk help center centre office department company limited inc ltd gmbh university institute school hospital street road avenue lane court square place drive row way open source blue green red black white silver "
    "gold dark light north south east west monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december english german french spanish "
    "windows linux python java docker kubernetes terraform ansible google amazon azure microsoft apache oracle if when while after before then and or but not with without from into over under is are was were be been has have had "
    "will can could should would must do does did use using used see run set get add make check change security operations engineering marketing sales finance design research general chief senior junior lead labs systems networks software technologies solutions analytics monitor studio hub engine console dashboard gateway agent framework inspector manager director".split()
)
# Cues of documents and registers, and what stands between them and the number.
ID_CUES = (
    "social security number|social security no|ssn|tax id|tax identification number|tax number|taxpayer id|tin|national id|national identity number|national identification number|"
    "national insurance number|national insurance no|nino|ni number|identity card number|identity card no|identity card|id card number|id card no|passport number|passport no|passport|"
    "driving licence number|driving licence|driving license|driver's licence|driver’s licence|driver's license|drivers license|driver license|resident permit|residence permit|health insurance number|medicare number|nhs number|"
    "steuer-id|steuernummer|steueridentifikationsnummer|idnr|ausweisnummer|personalausweisnummer|personalausweis|ausweis-nr|reisepass-nr|reisepassnummer|reisepass|sozialversicherungsnummer|rentenversicherungsnummer|"
    "führerscheinnummer|krankenversichertennummer|numéro de sécurité sociale|numero de securite sociale|n° de sécurité sociale|nir|carte d'identité|carte nationale d'identité|numéro de passeport|passeport|"
    "numéro fiscal|permis de conduire|dni|nie|nif|número de la seguridad social|número de seguridad social|número de identidad|documento de identidad|número de pasaporte|pasaporte|carné de conducir|"
    "codice fiscale|cpf|bsn|personnummer|pesel|aadhaar|curp"
).split("|")
PHONE_CUES = "tel phone call whatsapp mobile mob cell fax ring text number on-call oncall telefon telefonnummer handy rückruf anruf rufen téléphone tél portable appeler rappeler numéro teléfono móvil llame llamar número sms contact reach hotline".split()
STREET_CUES = (
    " street| st.| st,| avenue| ave| road| rd| lane| row| court| close| crescent| drive| place| square| terrace| way| boulevard| blvd| gardens| grove| mews| hill| parade| walk|"
    "rue |avenue |impasse |boulevard |chemin |allée |quai |cours |calle |avenida |plaza |paseo |camino |carrera |via |viale |piazza |rua |travessa |"
    "straße |strasse |str. |weg |allee |gasse |platz |damm |ufer |ring |steig |stieg |laan |straat "
).split("|")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    """All anchors over lowered text, each with the parser that expands it."""
    machine = ahocorasick.Automaton()
    kinds: dict[str, set[str]] = {}

    def add(word: str, kind: str) -> None:
        kinds.setdefault(word, set()).add(kind)

    for mark in ("@", " at ", "[at]", "(at)", "{at}", "<at>", " (a) "):
        add(mark, "email")
    for cue in ID_CUES:
        add(cue, "id")
    # where a number can begin, or two of its groups meet
    for mark in ("+", "(", "0", *(f"{d}{sign}" for d in "0123456789" for sign in "-.")):
        add(mark, "phone")
    for cue in PHONE_CUES:
        add(cue, "call")
    for cue in BEFORE_NAMES:
        add(cue.rstrip() if cue[-2] in ",:-" else cue, "who")
    for cue in AFTER_NAMES:
        add(cue, "did")
    for cue in STREET_CUES:
        add(cue, "address")
    for name in GIVEN_NAMES:
        add(name.lower() + " ", "name")
    for title in TITLES:
        add(title.lower() + " ", "title")
        add(title.lower() + ". ", "title")
    for word, found in kinds.items():
        machine.add_word(word, (len(word), tuple(sorted(found))))
    machine.make_automaton()
    return machine


# --- Parsers ----------------------------------------------------------------------------------

Span = tuple[str, int, int]

_LOCAL_BACK = re.compile(r"[\w.%+'-]{1,64}\Z")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])")
_SPELLED_LOCAL = re.compile(r"[A-Za-z0-9][\w.+-]{0,63}\s*\Z")
_SPELLED_DOMAIN = re.compile(r"\s*([A-Za-z0-9-]+(?:\s*(?:\[dot\]|\(dot\)|\{dot\}|<dot>|\sdot\s|\.)\s*[A-Za-z0-9-]+)+)", re.I)
_DOT_WORD = re.compile(r"(?i)\[dot\]|\(dot\)|\{dot\}|<dot>|\sdot\s")
_LOGIN_BEFORE = re.compile(r"(?:\b(?:ssh|scp|sftp|rsync|mosh|sshfs|ssh-copy-id|autossh|sshpass)\b[^\n|;&]*|://[^\s/]*|\bgit\s+(?:clone|remote|push|pull|fetch)\b[^\n|;&]*|\bgit\+ssh\S*)\Z")


def parse_email(text: str, at: int, end: int) -> Iterator[Span]:
    """Expand an at-sign (or its spelling) at ``at:end`` to an address, and validate it."""
    if text[at:end] == "@":
        m = _LOCAL_BACK.search(text, max(0, at - 64), at)
        d = _DOMAIN.match(text, end)
        if not m or not d:
            return
        start = m.start()
        local = m[0].lstrip(".'-")
        start = at - len(local)
        if not local or local.endswith(".") or ".." in local or not re.search(r"\w", local):
            return
        if start and text[start - 1] in "/:@=" and not re.search(r"(?i)(?:mailto:|=|:)\Z", text[max(0, start - 8) : start]):
            return
        stop = d.end()
        if text[stop : stop + 1] == ":" and re.match(r":[\w~./-]", text[stop : stop + 2]) and not re.match(r":\s|:$", text[stop : stop + 2]):
            return  # host:path of git, ssh or a port
        if text[stop : stop + 1] == "/" or local.lower() in ("git", "hg", "svn"):
            return
        line = text[text.rfind("\n", 0, start) + 1 : start]
        if _LOGIN_BEFORE.search(line):
            return
        yield "email", start, stop
        return
    local = _SPELLED_LOCAL.search(text, max(0, at - 66), at)
    d = _SPELLED_DOMAIN.match(text, end)
    if not local or not d:
        return
    dots = _DOT_WORD.search(d[1])
    domain = _DOT_WORD.sub(".", d[1]).replace(" ", "")
    stop = d.end(1)
    if not dots:
        if text[at:end] == " at " or not (plain := _DOMAIN.match(text, d.start(1))):
            return
        stop = plain.end()
    elif not re.search(r"\.[A-Za-z]{2,24}\Z", domain):
        return
    yield "email", local.start(), stop


# National and international forms. Groups of digits need marks, a leading + or 0, or a cue.
_PHONE = re.compile(
    r"""(?<![\w.+/@#-])(?<!\d:)(?:
      (?P<plus>\+\d{1,3}(?:[\s.\-/]?\(0\))?(?:[\s.\-/]?\(?\d{1,5}\)?){1,6})
    | (?P<zeros>00[1-9]\d{0,2}[\s.\-/]\(?\d{1,5}\)?(?:[\s.\-/]?\(?\d{1,5}\)?){0,5})
    | (?P<north>(?:1[\s.-])?\(\d{3}\)\s?\d{3}[\s.-]\d{4}|(?:1[\s.-])?\d{3}[.-]\d{3}[.-]\d{4}|\d{3}\s\d{3}[\s-]\d{4})
    | (?P<trunk>0\d{1,5}(?:[\s/.\-]+\d{2,8}){1,5}|0[1-9](?:[\s.]\d{2}){4}|\(0\d{2,5}\)\s?\d{3,8}(?:[\s-]\d{2,6})*)
    | (?P<solid>0[1-9]\d{8,10})
    )(?![\w@]|[.\-/:]\d)""",
    re.X,
)
_NO_PHONE_BEFORE = re.compile(
    r"(?i)(?:\b(?:account|order|job|build|ticket|invoice|epoch|offset|port|ports|range|version|id|no|nr|ssn|tax|passport|ref|pid|uid|gid|sku|isbn|commit|serial|case|issue|konto|auftrag|commande|compte|cuenta|pedido|"
    r"steuer-id|dni|ausweis\w*|sécurité sociale|insurance number)\b[\s.:#=°-]*(?:is|ist|est|es|no|nr|number|nummer)?[\s.:#=°-]*)\Z"
)
_PHONE_CUE = re.compile(r"(?i)\b(?:" + "|".join(map(re.escape, PHONE_CUES)) + r")\b[^\n\d]{0,24}\Z")
_PHONE_BEGIN = re.compile(r"(?:1[\s.-])?\(?\d{1,5}\Z")
_ONE_BEFORE = re.compile(r"(?<![\w.+/@#-])1[\s.-]\Z")
_NUMBER_AHEAD = re.compile(r"[^\n\d]{0,24}?(?=[+(]?\d)")


def parse_phone(text: str, start: int, end: int) -> Iterator[Span]:
    """Telephone numbers that begin at an anchor, or with the group of digits it ends."""
    mark = text[start:end]
    if mark in "+(0":
        if start and (text[start - 1].isalnum() or text[start - 1] in "_+/@#-."):
            return
        begins = [start]
        if mark == "(" and (m := _ONE_BEFORE.search(text, max(0, start - 3), start)):
            begins.insert(0, m.start())
    else:
        m = _PHONE_BEGIN.search(text, max(0, start - 9), start + 1)
        begins = [m.start()] if m else []
    for at in begins:
        if span := phone_at(text, at):
            yield span
            return


def parse_call(text: str, start: int, end: int) -> Iterator[Span]:
    """The first number behind a cue, in its line."""
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return
    if m := _NUMBER_AHEAD.match(text, end):
        if span := phone_at(text, m.end()):
            yield span


def phone_at(text: str, at: int) -> Span | None:
    """The number that begins at a place, checked by its form; bare digits only behind a cue."""
    m = _PHONE.match(text, at)
    if not m:
        return None
    digits = sum(map(str.isdigit, m[0]))
    if not 7 <= digits <= 16:
        return None
    before = text[max(0, at - 40) : at]
    if _NO_PHONE_BEFORE.search(before):
        return None
    kind = m.lastgroup
    if kind == "solid" and not _PHONE_CUE.search(before):
        return None
    if kind == "trunk" and (digits < 9 or re.fullmatch(r"0?\d{1,2}[./-]\d{1,2}[./-]\d{2,4}", m[0])) and not _PHONE_CUE.search(before):
        return None
    if kind == "trunk" and re.fullmatch(r"[\d.]+", m[0]) and m[0].count(".") < 3:
        return None
    if kind == "north" and re.fullmatch(r"\d{3}\s\d{3}[\s-]\d{4}", m[0]) and not _PHONE_CUE.search(before):
        return None
    if kind == "zeros" and digits < 10:
        return None
    return "phone", at, m.end() - (m[0].endswith(")") and m[0].count("(") < m[0].count(")"))


_ID_LINK = re.compile(
    r"(?i)(?:[\"']?\s*(?:[:=#]|\bis\b|\bist\b|\best\b|\bes\b|\bno\b\.?|\bnr\b\.?|\bnumber\b|\bnummer\b|n[°º]\.?|\bnúmero\b|\bnuméro\b|\(|\bwas\b|,|-)?\s*[\"']?){0,4}"
)
_ID_VALUE = re.compile(r"(?:[A-Z]{1,5}[ -]?)?\d(?:[ .\-/]?[0-9A-Z](?![a-z])){5,24}")

_ID_MIXED = re.compile(r"[A-Z0-9]{6,18}\b")


def parse_id(text: str, start: int, end: int) -> Iterator[Span]:
    """A number of a document behind its cue: five digits at least, in the cue's line."""
    if start and (text[start - 1].isalnum() or text[start - 1] in "_/"):
        return
    if end < len(text) and (text[end].isalpha() or text[end] == "_"):
        return
    link = _ID_LINK.match(text, end)
    at = link.end()
    m = _ID_VALUE.match(text, at)
    if not m and (m := _ID_MIXED.match(text, at)) and sum(map(str.isdigit, m[0])) < 4:
        m = None
    if not m or "\n" in text[end : m.start()]:
        return
    value = m[0].rstrip(" .-/")
    # a capital letter that begins the next sentence or word is no part of it
    value = re.sub(r"[ .]+[A-Z]\Z", lambda x: x[0] if re.match(r"[\s.,;)\"']|\Z", text[m.start() + len(value) : m.start() + len(value) + 1] or " ") and " " in x[0] and "." not in x[0] else "", value)
    if sum(map(str.isdigit, value)) < 5 or len(value) > 30:
        return
    yield "id_number", m.start(), m.start() + len(value)


_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’-]*"
_SUFFIX = r"(?:Street|St\.?|Avenue|Ave\.?|Road|Rd\.?|Lane|Ln\.?|Row|Court|Ct\.?|Close|Crescent|Drive|Dr\.?|Place|Pl\.?|Square|Sq\.?|Terrace|Way|Boulevard|Blvd\.?|Gardens|Grove|Mews|Hill|Parade|Walk)"
_CITY = rf"(?:Saint-|San |Santa |Sankt |Bad |St\. )?{_CAP}(?: (?:am|an der|sur|sous|upon|de|del|la) {_CAP})?"
_ADDRESSES = [
    re.compile(
        rf"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite|Room)\s\d+\w?,\s)?\b\d{{1,5}}[A-Za-z]?\s(?:{_CAP}\s){{1,3}}{_SUFFIX}(?![\w])"
        rf"(?:,\s(?:Flat|Apt\.?|Apartment|Unit|Suite)\s\d+\w?)?(?:,\s(?:\d{{4,5}}\s)?{_CITY}(?:,\s[A-Z]{{2}})?(?:\s\d{{4,5}}(?:-\d{{4}})?)?)?"
    ),
    re.compile(
        rf"\b\d{{1,4}}(?:\s?(?:bis|ter|[a-d]))?,?\s(?:rue|avenue|impasse|boulevard|chemin|allée|quai|place|cours|route)\s(?:(?:de la|de l['’]|des|du|de|d['’])\s?)?{_CAP}(?:[\s-](?:(?:de|des|du|la|le)\s)?{_CAP}){{0,3}}(?:,\s\d{{4,5}}\s{_CITY})?"
    ),
    re.compile(
        rf"\b(?:Calle|Avenida|Avda\.?|Plaza|Paseo|Camino|Carrera|Via|Viale|Piazza|Rua|Travessa)\s(?:(?:de la|de los|de las|del|de|di|della|da|do)\s)?{_CAP}(?:\s{_CAP}){{0,2}},?\s\d{{1,4}}[a-zA-Z]?(?:,\s(?:\d{{1,2}}[ºª°]?\s?\w?,\s)?\d{{4,5}}\s{_CITY})?"
    ),
    re.compile(
        r"\b[A-ZÄÖÜ][\wäöüß-]*(?:straße|strasse|str\.|weg|allee|gasse|platz|damm|ufer|ring|steig|stieg|laan|straat)\s\d{1,4}\s?[a-z]?(?![\w])" + rf"(?:,\s(?:D-)?\d{{4,5}}\s{_CITY})?"
    ),
    re.compile(rf"\b[A-ZÄÖÜ][\wäöüß-]+\s(?:Straße|Strasse|Str\.|Weg|Allee|Gasse|Platz|Damm|Ufer|Ring)\s\d{{1,4}}\s?[a-z]?(?![\w])(?:,\s(?:D-)?\d{{4,5}}\s{_CITY})?"),
]
_ADDRESS_REACH = 160


def parse_address(text: str, start: int, end: int) -> Iterator[Span]:
    """A street address around the word for a street: house number, street, and place behind it."""
    low = max(text.rfind("\n", 0, start) + 1, start - _ADDRESS_REACH)
    high = min(len(text), end + _ADDRESS_REACH)
    stop = text.find("\n", start)
    high = min(high, stop) if stop >= 0 else high
    for pattern in _ADDRESSES:
        for m in pattern.finditer(text, low, high):
            if m.start() < end and m.end() > start:
                yield "address", m.start(), m.end()
                return


_FAMILY = re.compile(r"(?:[A-Z]\.\s)?(?:(?:van der|van den|van|von|de la|de|del|di|da|dos|le|la|bin|al|O|Mc|Mac)[ '’-])?(?:[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{2,}(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?)(?![\w@]|\.\w)")
_FAMILY_UPPER = re.compile(r"(?:[A-Z]\.\s)?[A-ZÀ-ÖØ-Þ]{3,}(?:-[A-Z]+)?(?![\w@])")
_NEVER_FAMILY = frozenset(
    "the and for with from this that team group project store street road avenue lane court square place drive close crescent row way university institute school hospital award prize test server client "
    "street-level january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday code studio cloud office windows linux".split()
)


@lru_cache(maxsize=1)
def _letters() -> dict[str, float]:
    """Log-likelihood ratios of character trigrams of names against those of other words."""
    counts: list[dict[str, float]] = []
    others = [w for w in (*NO_NAME_WORDS, *re.findall(r"[a-z]{3,}", PROSE.lower()))]
    for words in ((*GIVEN_NAMES, *FAMILY_NAMES), others):
        own: dict[str, float] = {}
        for word in words:
            padded = f"^{word.lower()}$"
            for i in range(len(padded) - 2):
                own[padded[i : i + 3]] = own.get(padded[i : i + 3], 0.0) + 1.0
        counts.append(own)
    names, words = counts
    n, m = sum(names.values()), sum(words.values())
    size = len({*names, *words})
    return {g: math.log((names.get(g, 0) + 0.5) / (n + 0.5 * size)) - math.log((words.get(g, 0) + 0.5) / (m + 0.5 * size)) for g in {*names, *words}}


@lru_cache(maxsize=1 << 14)
def name_likeness(word: str) -> float:
    """How much a word reads like part of a name, from -1 to 1; unknown letters say nothing."""
    padded = f"^{word.lower()}$"
    ratios = [_letters().get(padded[i : i + 3], 0.0) for i in range(len(padded) - 2)]
    return max(-1.0, min(1.0, sum(ratios) / len(ratios)))


_GIVEN = frozenset(GIVEN_NAMES)
#: Weights of the features of a name and the sum from which two words are one.
NAME_WEIGHTS = {"listed": 2.0, "before": 1.7, "after": 1.6, "shape": 0.5, "letters": 0.8, "plain": -2.5, "lower": -1.5}
NAME_LEAST = 2.0
_PAIR = re.compile(rf"([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?)\s((?:[A-Z]\.\s)?(?:(?:van der|van den|van|von|de la|de|del|di|da|dos|le|la|bin|al|O|Mc|Mac)[ '’-])?[A-ZÀ-ÖØ-Þ][\w'’-]*[a-zß-öø-ÿ])(?![\w@]|\.\w)(?!\s[A-ZÀ-ÖØ-Þ][a-z]+\s[A-Z])")
_PAIR_BACK = re.compile(rf"(?<![\w@./'’-])([A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?)\s((?:[A-Z]\.\s)?[A-ZÀ-ÖØ-Þ][\w'’-]*[a-zß-öø-ÿ])\Z")
_GAP = re.compile(r"[ \t]?(?:\r?\n)?")
_THING_BEHIND = re.compile(r"[ -](?:team|group|project|server|service|cluster|platform|api|library|release|foundation|street|road|avenue|university|institute)s?\b", re.I)


def name_score(text: str, first: str, last: str, end: int, **features: bool) -> float:
    """The evidence that two capitalised words are a person's given and family name.

    Lists are one feature; the others are the words before and behind, the shape and letters of
    both, plain words among them, and their use in lower case elsewhere in the text.
    """
    w = NAME_WEIGHTS
    family = last.split()[-1]
    total = w["listed"] * (first in _GIVEN) + sum(w[name] for name, holds in features.items() if holds)
    total += w["shape"] * (3 <= len(first) <= 14 and 3 <= len(family) <= 18)
    total += w["letters"] * (0.0 if first in _GIVEN else name_likeness(first) + name_likeness(family)) / 2
    if first.lower() in NO_NAME_WORDS or family.lower() in NO_NAME_WORDS or family.lower() in _NEVER_FAMILY or _THING_BEHIND.match(text, end):
        total += w["plain"]
    elif re.search(rf"(?<![\w-])(?:{re.escape(first.lower())}|{re.escape(family.lower())})(?![\w-])", text):
        total += w["lower"]
    return total


def parse_who(text: str, start: int, end: int) -> Iterator[Span]:
    """A name behind words that introduce a person."""
    if start and text[start].isalpha() and text[start - 1].isalnum():
        return
    m = _PAIR.match(text, _GAP.match(text, end).end())
    if m and m[1] not in _GIVEN and name_score(text, m[1], m[2], m.end(), before=True) >= NAME_LEAST:
        yield "name", m.start(), m.end()


def parse_did(text: str, start: int, end: int) -> Iterator[Span]:
    """A name before what only people do."""
    if end < len(text) and text[end].isalnum():
        return
    m = _PAIR_BACK.search(text, max(0, start - 60), start)
    if m and m[1] not in _GIVEN and name_score(text, m[1], m[2], m.end(), after=True) >= NAME_LEAST:
        yield "name", m.start(), m.end()


def parse_name(text: str, start: int, end: int) -> Iterator[Span]:
    """A listed given name with the family name behind it."""
    if start and (text[start - 1].isalnum() or text[start - 1] in "_@-'’/"):
        return
    given = text[start : end - 1]
    upper = given.isupper() and len(given) > 2
    if not (given[:1].isupper() and (given[1:].islower() or upper)):
        return
    m = (_FAMILY_UPPER if upper else _FAMILY).match(text, end)
    if m and m[0].split()[-1].lower() not in _NEVER_FAMILY:
        yield "name", start, m.end()


_TITLE_FAMILY = re.compile(r"(?:[A-Z]\.\s){0,2}(?:[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+\s(?=[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]))?(?:(?:van|von|de la|de|del|di|da|le|la)\s)?[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?(?![\w@]|\.\w)")
_TITLE_UPPER = re.compile(r"(?:[A-Z]\.\s){0,2}[A-ZÀ-ÖØ-Þ]{3,}(?![\w@])")
_BARE_M = re.compile(r"M\s")


def parse_title(text: str, start: int, end: int) -> Iterator[Span]:
    """A title with the family name behind it."""
    if start and (text[start - 1].isalnum() or text[start - 1] in "_@-'’/."):
        return
    title = text[start:end].strip().rstrip(".")
    if not title[:1].isupper() or title == "M" and "." not in text[start:end]:
        return
    if len(title) > 1 and title.isupper():
        m = _TITLE_UPPER.match(text, end)
    else:
        m = _TITLE_FAMILY.match(text, end)
    if m and m[0].split()[-1].lower() not in _NEVER_FAMILY:
        yield "name", start, m.end()


_PARSERS = {
    "email": parse_email, "id": parse_id, "phone": parse_phone, "call": parse_call, "address": parse_address, "name": parse_name, "title": parse_title, "who": parse_who, "did": parse_did,
}
_RANK = {"email": 0, "id_number": 1, "address": 2, "phone": 3, "name": 4}


def spans_of(text: str | None) -> list[Span]:
    """(kind, start, end) of all personal information in a text, in order and apart.

    One automaton finds all anchors (at-signs and their spellings, cues of documents, signs and cues
    of telephone numbers, words for streets, given names, titles, and words before and behind
    people); the parser of an anchor expands it to both sides and checks it.
    Where spans overlap, an address of mail goes before a number, a street, a phone and a name.
    """
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    found: list[Span] = []
    for last, (size, kinds) in _automaton().iter(low):
        end = last + 1
        for kind in kinds:
            found += _PARSERS[kind](text, end - size, end)
    if not found:
        return []
    kept: list[Span] = []
    for span in sorted(found, key=lambda s: (_RANK[s[0]], s[1] - s[2])):
        if all(span[1] >= k[2] or span[2] <= k[1] for k in kept):
            kept.append(span)
    return sorted(kept, key=lambda s: s[1])


def replace(text: str | None) -> str | None:
    """The text with a typed placeholder for every piece of personal information."""
    if not text:
        return text
    parts, last = [], 0
    for kind, a, b in spans_of(text):
        parts += [text[last:a], f"[{kind.upper()}]"]
        last = b
    return "".join([*parts, text[last:]])


def find_personal(df: DataFrame, id_column: str = "pair_id", fields: tuple[str, ...] = ("input", "output")) -> DataFrame:
    """(pair_id, field, kind, start, end) of every piece of personal information.

    Kinds: ``email`` (also spelled out; not targets of ssh, git and connection urls), ``phone``,
    ``id_number`` (of personal documents and registers), ``address`` (street addresses), ``name``
    (given and family name, or title and family name; a given name that isn't listed counts where
    context, shape and letters speak for it, see :func:`name_score`). Offsets count code points. Null and empty
    texts give no rows; whole texts are read; repeated rows come out repeated; other columns are
    not read. No shuffle.
    """
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, *columns: list) -> tuple:
            rows = [(key, name, *span) for name, texts in zip(fields, columns) for key, text in zip(keys, texts) for span in spans_of(text)]
            return tuple(map(list, zip(*rows))) if rows else ([],) * 5

        return work

    return map_columns(df, [id_column, *fields], make, f"pair_id {kind}, field string, kind string, start int, end int")


def replace_personal(df: DataFrame, id_column: str = "pair_id", fields: tuple[str, ...] = ("input", "output")) -> DataFrame:
    """The id and the fields of every row with typed placeholders, otherwise unchanged; nulls stay."""
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        return lambda keys, *columns: (keys, *[[replace(t) for t in texts] for texts in columns])

    return map_columns(df, [id_column, *fields], make, ", ".join([f"{id_column} {kind}", *[f"{f} string" for f in fields]]))
