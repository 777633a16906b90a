"""The language of prose by its function words and script."""

from __future__ import annotations

import re
from collections.abc import Iterable

# Frequent function words of languages written in Latin letters.
FUNCTION_WORDS = {
    "en": "the of and to is in that it its for not with so before what how after our you are be or by on at as if then this which when was were has have from into only while until without your",
    "de": "der die das und ist nicht mit für wird auf den dem des von zu nach bis wenn ohne muss ein eine einen einer im zum zur sich auch danach damit sind werden kann ich sie wie warum welche welcher sobald liegt seit aus bei dass aber man statt oder",
    "fr": "le la les et est dans que pour une un du des sur par avec sans qui ne pas après dès ou au aux cette ce quand comment pourquoi quelle quel faut vous il elle se sont puis depuis lorsque entre chaque son sa ensuite être",
    "es": "el la los las y es en que para una un del con sin por se después cuando hay al como qué cómo cuál más pero lo su cada desde hasta entre está son luego también si conviene muy",
    "pt": "o os a as e é em que para uma um do da dos das no na nos nas com sem não após se quando até por ao à cada depois também entre são mais mas pelo pela deve há foi seu sua como",
    "it": "il lo gli le di che è per non con una un del della dei delle nel nella sul dopo se quando si sono anche come ma più al alla ogni dal dalla viene tra può senza finché",
    "nl": "de het een en is niet met voor van op na wordt als bij dat die te zijn naar door aan maar ook om uit over wanneer zonder tot tussen elke deze moet kan worden",
    "pl": "nie jest się do po przez dla że jak ale lub oraz gdy przed bez jest są może który która które tylko już ze od każdy każda",
    "sv": "och är inte med för på av att efter som den det en ett till från när eller om kan ska mellan utan varje också sedan",
}
_FLAGS: dict[str, tuple[str, ...]] = {}
for _name, _words in FUNCTION_WORDS.items():
    for _word in _words.split():
        if len(_word) > 1:  # single letters are names of things too
            _FLAGS[_word] = (*_FLAGS.get(_word, ()), _name)

# Blocks of letters that tell a language, or nearly so.
SCRIPTS = {
    "ja": re.compile(r"[぀-ヿ]"),
    "zh": re.compile(r"[㐀-鿿]"),
    "ko": re.compile(r"[가-힯ᄀ-ᇿ]"),
    "ru": re.compile(r"[Ѐ-ӿ]"),
    "el": re.compile(r"[Ͱ-Ͽ]"),
    "ar": re.compile(r"[؀-ۿ]"),
    "he": re.compile(r"[֐-׿]"),
    "hi": re.compile(r"[ऀ-ॿ]"),
    "th": re.compile(r"[฀-๿]"),
}
_BEYOND_LATIN = re.compile(r"[Ͱ-鿿가-힯]")

# Names of languages, in those languages a question may be asked in.
NAMES = {
    "en": "english englisch englische englischen anglais anglaise inglés inglesa",
    "de": "german deutsch deutsche deutschen deutscher allemand allemande alemán alemana",
    "fr": "french französisch französische französischen français française francés francesa",
    "es": "spanish spanisch spanische spanischen espagnol espagnole español española castellano",
    "pt": "portuguese portugiesisch portugiesische portugais portugaise portugués portuguesa português brazilian",
    "it": "italian italienisch italienische italien italienne italiano italiana",
    "nl": "dutch niederländisch holländisch néerlandais néerlandaise neerlandés holandés",
    "pl": "polish polnisch polnische polonais polonaise polaco polaca",
    "sv": "swedish schwedisch suédois suédoise sueco sueca",
    "ru": "russian russisch russische russe ruso rusa русский русском",
    "zh": "chinese chinesisch chinesische mandarin chinois chinoise chino china 中文",
    "ja": "japanese japanisch japonais japonaise japonés japonesa 日本語",
    "ko": "korean koreanisch coréen coréenne coreano coreana",
    "ar": "arabic arabisch arabe árabe",
    "el": "greek griechisch grec grecque griego griega",
    "hi": "hindi",
    "th": "thai thailändisch",
    "he": "hebrew hebräisch hébreu hebreo",
}
_NAMED = {word: code for code, words in NAMES.items() for word in words.split()}
_TRANSLATE = re.compile(r"\b(?:translat\w*|übersetz\w*|tradui\w*|traduc\w*|traduz\w*)\b", re.I)


def counts_of(words: Iterable[str]) -> dict[str, int]:
    """How many function words of every language there are among lowered words."""
    out: dict[str, int] = {}
    flags = _FLAGS
    for word in words:
        for code in flags.get(word, ()):
            out[code] = out.get(code, 0) + 1
    return out


# Letters by which a language is told from those that share its small words.
LETTERS = {"pt": "ãõâ", "es": "ñ¿¡", "de": "ßäöü", "sv": "åäö", "pl": "ąćęłńśźż", "fr": "èêëçœùû", "it": "òìù"}


def language_of(prose: str, words: list[str], least: int = 2) -> tuple[str | None, dict[str, int]]:
    """The language of a prose text (None if unsure) and the evidence for every language."""
    counts = counts_of(words)
    latin = max(counts.values(), default=0)
    if _BEYOND_LATIN.search(prose):
        marks = {code: len(pattern.findall(prose)) for code, pattern in SCRIPTS.items()}
        code = max(marks, key=marks.get)
        if code == "zh" and marks["ja"] * 4 > marks["zh"]:
            code = "ja"
        if marks[code] >= 6 and marks[code] > 4 * latin:
            return code, counts | {code: marks[code]}
    if latin < least:
        return None, counts
    ranked = sorted(counts.items(), key=lambda x: -x[1])
    even = [code for code, n in ranked if n == ranked[0][1]]
    if len(even) > 1:  # told by their letters, if at all
        low = prose.lower()
        marks = sorted(((sum(map(low.count, LETTERS.get(code, ""))), code) for code in even), reverse=True)
        return (marks[0][1] if marks[0][0] > marks[1][0] else None), counts
    return ranked[0][0], counts


def asked_for(words: Iterable[str], code: str, text: str) -> bool:
    """Whether a question names language ``code``, or asks for a translation without naming any."""
    named = {_NAMED[w] for w in words if w in _NAMED}
    return code in named or not named and bool(_TRANSLATE.search(text))
