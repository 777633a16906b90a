"""Problem 1: prompt and response pairs that are broken, with the kind of defect."""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame

from lathework.functions.batches import map_columns
from lathework.llm.languages import asked_for, language_of
from lathework.llm.words import WORD

# --- Empty answers ----------------------------------------------------------------------------

# What people write in place of nothing.
STAND_INS = frozenset(
    "|n/a|na|none|null|nil|nan|undefined|empty|blank|no answer|no answer given|no response|no reply|no output|no content|"
    "answer|the answer|response|output|reply|solution|tbd|todo|to do|unknown|nothing|not available|not applicable|missing|deleted|removed|"
    "keine antwort|antwort|leer|nichts|entfällt|k a|aucune réponse|pas de réponse|réponse|vide|rien|néant|s o|"
    "sin respuesta|respuesta|vacío|nada|ninguno|no aplica|n d|answer here|your answer|your answer here|see attachment|placeholder|lorem ipsum|x|xx|xxx".split("|")
)
_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_MARKS = re.compile(r"[\W_]+")
_SHORT = 200


def is_empty(output: str | None) -> bool:
    """Whether an answer has no content: null, blank, bare markup, or a stand-in for nothing."""
    if not output:
        return True
    text = output.strip()
    if len(text) > _SHORT and WORD.search(text[:_SHORT]) and "<" not in text[:_SHORT] and "&" not in text[:_SHORT]:
        return False
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if text.lower().strip() in STAND_INS:
        return True
    return _MARKS.sub(" ", text).strip().lower() in STAND_INS


# --- Copied questions -------------------------------------------------------------------------

_LABELS = frozenset("question q answer a frage antwort réponse pregunta respuesta prompt instruction input task aufgabe tarea consigne response re ask asked".split())
SHINGLE = 3


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, by one big integer of bits per word of ``a``."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def is_copy(answer: list[str], question: list[str], extra: list[str]) -> bool:
    """Whether an answer is only the question, its input, or both.

    Shingles of the answer must be contained in the question's; then the longest common
    subsequence must cover the answer (but for a label) and a whole one of the sides.
    """
    while answer and answer[0] in _LABELS and len(answer) > 1 and answer[:1] != question[:1] and answer[:1] != extra[:1]:
        answer = answer[1:]
    half = len(answer) // 2
    if len(answer) % 2 == 0 and answer[:half] == answer[half:]:
        answer = answer[:half]
    n = len(answer)
    if n == 0 or n > len(question) + len(extra) + 3:
        return False
    runs = [tuple(answer[i : i + SHINGLE]) for i in range(n - SHINGLE + 1)] or [tuple(answer)]
    known = set()
    for side in (question, extra, question + extra, extra + question):
        known.update(tuple(side[i : i + SHINGLE]) for i in range(max(1, len(side) - SHINGLE + 1)))
    if sum(r in known for r in runs) < 0.9 * len(runs):
        return False
    for side in (question, extra, question + extra, extra + question):
        if side and abs(len(side) - n) <= 3 + 0.1 * len(side):
            common = lcs_length(side, answer)
            if common >= 0.95 * n and common >= 0.9 * len(side):
                return True
    return False


# --- Refusals ---------------------------------------------------------------------------------

# Families of words, in the languages that are told apart. A word can be in several.
FAMILIES = """
SELF: i we ourselves myself assistant model ai bot chatbot program ich wir je j'ai nous m'est moi yo nosotros eu noi assistent asistente assistente modell modèle modelo ki ia puedo podemos prefiero daré daremos debo debemos tengo estoy voy niego peux préfère dois posso prefiro estou
MINE: me my us our makers creators developers mir mich uns mein meine meinen meiner meinem me mes ma mon mi mis nos
NEG: not no never nothing none without unable nicht kein keine keinen keiner nichts impossible imposible unmöglich nie ne n'est n'ai pas rien jamais aucun aucune ni no nunca nada ningún ninguna não non
ABLE: can could may able unable allowed allow permitted permit authorized authorised cleared clear equipped capable licensed position free will way let kann könnte können darf dürfen möglich erlaubt befugt lage imstande möchte werde peux puis peut pouvons autorisé autorisée permis permet mesure puedo podemos puede permitido permite autorizado capaz condiciones voy impossible imposible unmöglich posso possiamo possível pode podem
ACT: help assist answer answers answered answering respond reply provide discuss discussed talk speak comment comply fulfil fulfill engage tell say advise instructions weigh explain describe helfen hilfe beantworten beantwortet antworten antworte antwort auskunft sprechen sagen äußern weiterhelfen bearbeiten erfüllen aider répondre parler dire fournir discuter renseigner traiter donner ayudar ayudarle ayudarte responder contestar hablar decir proporcionar atender dar ajudar responder falar aiutare rispondere parlare daré daremos instrucciones
DECLINE: decline declines declined refuse refuses refused reject rejected deny denied withhold withheld skip abstain unanswered ablehnen abgelehnt lehne verweigern verweigere verweigert unbeantwortet refuser refuse refusée décliner décline renoncer rechazar rechazo rechazada negar niego declinar declino recusar rifiutare
TOPIC: this that it these those such request requests question questions topic subject prompt prompts matter query content one anfrage frage fragen thema dies diese dieser dieses das dazu damit darüber dabei hierzu inhalt demande question questions sujet cela ça ceci ce cette contenu solicitud pregunta preguntas tema eso esto ello petición contenido pergunta isso isto tema pedido domanda questo
RULE: policy policies guideline guidelines rules rule safety security terms ethics principles limits scope richtlinien regeln sicherheitsgründen vorgaben grundsätze règles consignes sécurité politique limites normas reglas política seguridad directrices
AGAINST: against violates violate violating break breaks prohibits prohibited forbids forbidden outside beyond off appropriate comfortable verstößt gegen verboten untersagt außerhalb contre interdit interdisent enfreint hors contra viola prohíben prohibido fuera
PREFER: rather prefer lieber ungern préfère préférerais prefiero preferiría prefiro preferisco
KNOW: knowledge access idea clue information know tell wissen kenntnis zugriff weiß connaissance accès sais conocimiento acceso sé
SORRY: sorry apologies apologise apologize unfortunately regret afraid leider leid bedaure bedauere désolé désolée malheureusement regrette siento lamento lamentablemente desculpe infelizmente dispiace
ASK: ask contact consult try reach turn check please feel fragen fragt stellen wenden bitte versuchen posez demandez contactez consultez adressez veuillez essayez haga pregunte consulte contacte pruebe póngase puede
ELSE: else elsewhere other another different others anybody somebody someone somewhere something anything anderes andere anderen anderer sonst jemand woanders autre autres ailleurs quelqu'un otra otro otras otros alguien outra outro altro
CHANGE: change let's talk wechseln reden changeons parlons cambiemos hablemos
""".strip().splitlines()
# Templates of refusals, as families in their order; the answer's sentences are aligned
# to them by longest common subsequence. A template must be found whole.
REFUSALS = """
SELF ABLE NEG ACT
SELF NEG ABLE ACT
SELF NEG ABLE TOPIC
ABLE SELF NEG ACT
ABLE SELF TOPIC NEG ACT
ABLE SELF NEG TOPIC
ABLE NEG ACT you
NEG ABLE MINE ACT
NEG ABLE MINE TOPIC
SELF NEG ACT TOPIC
TOPIC ABLE SELF NEG
TOPIC ACT SELF NEG
TOPIC SELF NEG ACT
TOPIC SELF NEG ABLE
TOPIC NEG MINE ABLE
TOPIC NEG ABLE MINE
RULE NEG ABLE MINE
TOPIC ABLE NEG ACT
TOPIC NEG ABLE ACT
TOPIC NEG SELF ABLE
TOPIC NEG SELF ACT
SELF DECLINE
SELF TOPIC DECLINE
TOPIC SELF DECLINE
DECLINE TOPIC
TOPIC DECLINE
SELF PREFER NEG ACT
SELF PREFER NEG TOPIC one
TOPIC PREFER SELF NEG
SELF PREFER NEG this one
PREFER SELF NEG ACT
PREFER NEG ACT
AGAINST MINE RULE
TOPIC AGAINST RULE
TOPIC AGAINST SELF ABLE
NEG AGAINST MINE ACT
RULE NEG SELF ACT
RULE SELF NEG ACT
SELF RULE NEG ACT
SELF NEG auskunft
NEG MINE ABLE ACT
NEG ACT MINE
NEG ACT RULE
NEG SELF ABLE ACT
NEG SELF KNOW
SELF NEG KNOW ACT
SELF NEG KNOW TOPIC
SELF NEG TOPIC ACT
TOPIC NEG SELF ACT
SELF NEG ACT RULE
TOPIC AGAINST for MINE
NEG AGAINST MINE TOPIC
off limits
CHANGE ELSE TOPIC
CHANGE TOPIC
CHANGE ELSE than
SELF NEG way
""".strip().splitlines()

# What may stand beside a refusal without making it an answer.
PLEASANTRIES = """
no
nope
nein
non
hello
hi there
hi
hey
dear user
hmm
well
ok
okay
sure
note
thank you for your question about *
thank you for your question
thanks for asking
thank you for reaching out
that is an interesting topic
that is a good question
good question
is there anything about * on your mind
is there anything else i can help with
is there something else i can help you with
if you have another question on * feel free to ask
feel free to ask something else
please feel free to ask another question
please contact whoever runs *
please consult the vendor of *
please contact support
please consult a professional
please ask something else
please try another question
i hope you understand
thank you for your understanding
have a nice day
best regards
kind regards
sorry
i am sorry
my apologies
hallo
guten tag
vielen dank für ihre frage
danke für die frage
das ist ein interessantes thema
gern beantworte ich andere fragen
bitte stellen sie eine andere frage
bitte wenden sie sich an *
kann ich sonst noch helfen
bonjour
merci pour votre question
c'est un sujet intéressant
posez moi une autre question
n'hésitez pas à poser une autre question
veuillez contacter *
hola
buenos días
gracias por su pregunta
es un tema interesante
haga otra pregunta
puede hacer otra pregunta
consulte a *
póngase en contacto con *
""".strip().splitlines()

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*(?:-[^\W_]+)*")
_SENTENCES = re.compile(r"(?<=[.!?])[\"'”’)*]*\s+|\n+")
_CONTRACTED = {
    "can't": "can not", "cannot": "can not", "i'm": "i am", "i'd": "i would", "i've": "i have", "isn't": "is not", "won't": "will not", "wouldn't": "would not", "aren't": "are not", "didn't": "did not", "haven't": "have not", "hasn't": "has not", "wasn't": "was not", "don't": "do not",
    "doesn't": "does not", "that's": "that is", "there's": "there is", "it's": "it is", "couldn't": "could not", "i'll": "i will",
    "ki-modell": "ki modell", "chat-programm": "chat programm", "posez-moi": "posez moi",
}
SLOT = 6
ALIGNED = 0.85


def _tokens(text: str) -> list[str]:
    out: list[str] = []
    for token in _TOKEN.findall(text.lower().replace("’", "'")):
        out += _CONTRACTED.get(token, token).split()
    return out


class Templates:
    """Templates indexed by their words, for alignment."""

    def __init__(self, lines: list[str]) -> None:
        self.rows = []
        self.by_word: dict[str, set[int]] = {}
        for at, line in enumerate(lines):
            words = [w for part in line.split() for w in (["*"] if part == "*" else _tokens(part))]
            fixed = [w for w in words if w != "*"]
            self.rows.append((fixed, words.count("*"), set(fixed)))
            for w in set(fixed):
                self.by_word.setdefault(w, set()).add(at)

    def fits(self, sentence: list[str]) -> bool:
        """Whether a sentence is one of the templates, word by word but for slots and a few words."""
        n = len(sentence)
        have = set(sentence)
        rows: dict[int, int] = {}
        for word in have:
            for at in self.by_word.get(word, ()):
                rows[at] = rows.get(at, 0) + 1
        for at, shared in rows.items():
            fixed, slots, distinct = self.rows[at]
            if shared < ALIGNED * len(distinct):
                continue
            free = n - len(fixed)
            if free > SLOT * slots + 2 or free < -1:
                continue
            if lcs_length(fixed, sentence) >= ALIGNED * len(fixed):
                return True
        return False


_PLEASE = Templates(PLEASANTRIES)
_FAMILY: dict[str, list[str]] = {}
for _line in FAMILIES:
    _name, _, _words = _line.partition(": ")
    for _word in _words.split():
        if _name not in _FAMILY.setdefault(_word, []):
            _FAMILY[_word].append(_name)
_PATTERNS = [line.split() for line in REFUSALS]
#: Places that one alignment may span, and words of a sentence that are in no family and not in the question.
REACH = 14
FREE = 9
#: The same where a template only names a refusal, which a system can make as well.
BARE = 2
#: A sentence goes on to an answer behind these.
_TURN = frozenset("but however instead though here following aber jedoch stattdessen sondern hier mais cependant plutôt voici pero sino aunque aquí".split())


#: Every template has one of these.
_CORE = frozenset({"NEG", "DECLINE", "AGAINST", "CHANGE", "off"})


def refuses(words: list[str], question: Callable[[], set[str]]) -> bool:
    """Whether a sentence is a refusal: a template of families is aligned whole within ``REACH`` words.

    Words of the question are its topic and count for nothing; a sentence with more than ``FREE``
    other words, or that turns to something else after the alignment, says more than no.
    """
    places = [(at, name) for at, word in enumerate(words) for name in (*_FAMILY.get(word, ()), word)]
    names = [name for _, name in places]
    have = set(names)
    if have.isdisjoint(_CORE):
        return False
    free = _others(words, question)
    if free > FREE:
        return False
    for pattern in _PATTERNS:
        if not have.issuperset(pattern) or lcs_length(pattern, names) < len(pattern):
            continue
        end = _tightest(pattern, places)
        if end is not None and (free <= BARE or "DECLINE" not in pattern):
            behind = words[end + 1 :]
            turn = next((i for i, w in enumerate(behind) if w in _TURN), None)
            if turn is None or len(behind) - turn <= 4 or any(n in ("SELF", "ELSE") for w in behind[turn:] for n in _FAMILY.get(w, ())):
                return True
    return False


def _others(words: list[str], question: Callable[[], set[str]]) -> int:
    """How many words are in no family, not in the question and mean something."""
    left = [w for w in words if w not in _FAMILY and w not in _SMALL]
    return sum(w not in question() for w in left) if left else 0


def _tightest(pattern: list[str], places: list[tuple[int, str]]) -> int | None:
    """Where the alignment of a pattern within ``REACH`` words ends, if there is one."""
    for start, (first, name) in enumerate(places):
        if name != pattern[0]:
            continue
        k, last = 1, first
        for at, other in places[start + 1 :]:
            if at - first >= REACH or k == len(pattern):
                break
            if other == pattern[k]:
                k, last = k + 1, at
        if k == len(pattern):
            return last
    return None


# Words without a meaning of their own beside a refusal.
_SMALL = frozenset(
    "a an the to of in on at for with about from by as am is are be been was were do does did have has had would should must and or if so any there what which you your out give given get go "
    "zu der die den dem ein eine einen einer im am an auf von für mit über bin ist sind habe hat muss und oder sie ihnen ihre ihr es "
    "le la les l un une des de d du à au aux sur pour avec en suis est sont ai et ou vous votre que qui il "
    "el la los las un una de del al a en sobre para con por es son he tengo y o que se le su usted lo "
    "o os as um uma do da em il lo di che".split()
)
_FENCED = re.compile(r"```.*?(?:```|\Z)", re.S)
_CODE_SPAN = re.compile(r"`[^`\n]*`")
CODE_WORD = "codespan"


def is_refusal(output: str, question: str = "") -> bool:
    """Whether an answer declines and gives nothing else: every sentence aligns to a template.

    A code span stands for a name; a block of code is an answer.
    """
    if "```" in output and _FENCED.search(output):
        return False
    if "`" in output:
        output = _CODE_SPAN.sub(f" {CODE_WORD} ", output)
    refused = False
    topic = cache(lambda: {CODE_WORD, *_tokens(question)})
    for sentence in _SENTENCES.split(output.strip()):
        words = _tokens(sentence)
        if not words:
            continue
        if refuses(words, topic):
            refused = True
        elif not (_PLEASE.fits(words) or len(words) == 1 and words[0] in _PLEASE.by_word or _is_side(words, topic)):
            return False
    return refused


def _is_side(words: list[str], topic: Callable[[], set[str]]) -> bool:
    """Whether a sentence only regrets or sends one elsewhere."""
    names = {n for w in words for n in _FAMILY.get(w, ())}
    side = "ELSE" in names and ("ASK" in names or "ACT" in names) or "SORRY" in names and len(words) <= 4
    return side and _others(words, topic) <= 3


# --- Truncated answers ------------------------------------------------------------------------

# Notices that a text was cut, and words no sentence ends on.
_CUT_NOTICE = re.compile(
    r"""(?:[\[(<{]|\.{3}|…)[\s.…\[(<{#/*-]*(?:(?:output|text|answer|response|message|content|rest|remainder)\s+)?(?:was\s+|is\s+)?
        (?:truncated|continued|to\ be\ continued|cut(?:\ (?:off|short|here|at\b[^\n]{0,40}))?|snip(?:ped)?\b[^\n]{0,60}|omitted|abridged|shortened|
           gekürzt|abgeschnitten|fortsetzung(?:\ folgt)?|wird\ fortgesetzt|tronqué\w*|coupé\w*|suite|à\ suivre|truncado|cortado|recortado|continúa|continuará|limit\ reached|max(?:imum)?\ (?:length|tokens)[^\n]{0,20})
        \s*(?:[\])>}]|\*/|-->)?\W*\Z
      | \b(?:(?:output|answer|response|text|message)\ (?:was\ |is\ |has\ been\ )?(?:truncated|cut\ off|cut\ short)|to\ be\ continued|(?:token|length|character|output)\ limit\ (?:was\ )?reached|
           fortsetzung\ folgt|wurde\ (?:gekürzt|abgeschnitten)|a\ été\ (?:tronquée?|coupée?)|fue\ (?:truncad[ao]|cortad[ao])|à\ suivre|continuará)\b[^\n]{0,40}\W*\Z""",
    re.I | re.X,
)
_DANGLING = frozenset(
    "the a an and or but because if so that which while when with without to of for from into than as at by on in is are was were be been has have had "
    "then you your our its their this these those else only not also very more per via between before after until unless although though where whose who what how "
    "und oder aber weil wenn damit dass die der das den dem des ein eine einen einem einer mit ohne zu zum zur von vom für auf in im an am aus bei bis nach ist sind wird werden danach sobald als wie auch nicht "
    "et ou mais parce que qui dont la le les un une des du de au aux avec sans pour par sur dans est sont ensuite puis lorsque si comme afin ne "
    "y o pero porque que la el los las un una de del al con sin para por en es son después luego cuando si como se su muy "
    "e ou mas porque o os as com sem para uma um do da no na".split()
)
_CLOSERS = re.compile(
    r"(?i)(?:\b(?:hope (?:that|this) helps|this helps|that helps|hth|cheers|good luck|thanks|thank you|best|regards|best regards|kind regards|greetings|viele grüße|"
    r"beste grüße|mit freundlichen grüßen|liebe grüße|lg|mfg|cordialement|bien à vous|bonne chance|salutations|merci|saludos|un saludo|gracias|suerte|viel erfolg|done|enjoy)\b[\s:;)!(-]*(?:\S+\s*){0,4}$)"
    r"|https?://\S+$|[:;]-?[)D(]$|\bemail\b|@\S+$|^\s*(?:--|—|-)\s*[A-Z]\S*(?:\s+\S+){0,4}$"
)
_STOPPED = re.compile(r"[.!?。！？…।؟][\"'”’»)\]*_`~]*$")
_CODE_LINE = re.compile(
    r"^\s*(?:#!|//|/\*|\*/|--\s|<!--|import\s|from\s+\S+\s+import|def\s|class\s|return\b|export\s|cp\s|mv\s|rm\s|test\s|set\s+-|echo\s|cat\s|sudo\s|docker\s|kubectl\s|"
    r"if\s.*[:{]$|for\s.*[:{]$|while\s.*[:{]$|with\s.*:$|else:|try:|except\b|raise\s|log\.|print\(|const\s|let\s|var\s|func\s|resource\s+\"|variable\s+\"|\[[\w.-]+\]$|[{}\[\]()],?$|"
    r"[\w.\"'-]+\s*[:=]\s*\S|[\w-]+:$|\"[^\"]+\"\s*:|\S+\s*=\s*\S+|\w+\(.*\)\s*;?$|\$\s)"
)
_FENCE = re.compile(r"^[ \t]*(?:>[ \t]*)*```", re.M)
_TRAILING = re.compile(r"[\s​‌‍⁠﻿]+\Z")
_LIST = re.compile(r"^\s*(?:[-*+•]|\d+[.)])\s+")
_ENDED = re.compile(r"[.!?。！？]\)?[\"'”’]?(?:\s|$)")


def _open_brackets(code: str) -> bool:
    """Whether more brackets are opened than closed, apart from those in strings."""
    bare = re.sub(r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'", "", code)
    return any(bare.count(a) > bare.count(b) for a, b in ("{}", "()", "[]"))


def is_truncated(output: str) -> bool:
    """Whether an answer breaks off before its end, or says that it was cut."""
    text = _TRAILING.sub("", output)
    tail = text[-160:]
    if _CUT_NOTICE.search(tail):
        return True
    fences = len(_FENCE.findall(text)) if "```" in text else 0
    if fences % 2:
        return True
    if text.endswith("```"):
        return False
    if _STOPPED.search(tail):
        return False
    last = text[text.rfind("\n") + 1 :]
    after_code = text[text.rfind("```") + 3 :] if fences else text
    lines = [x for x in after_code.split("\n") if x.strip()]
    codeish = sum(bool(_CODE_LINE.match(x)) for x in lines)
    if not fences and lines and (_CODE_LINE.match(last) or codeish * 2 > len(lines)) and codeish >= min(2, len(lines)):
        # code without fences: it may not end within a statement or a bracket
        return bool(re.search(r"(?:[,(\[{\\=+]|&&|\|\||:)\s*$", last)) or _open_brackets(text)
    if last.count("`") % 2:
        return True
    if _CLOSERS.search(last):
        return False
    if re.search(r"[,;:(\[{–—=]$|[^-]-$", last):
        return True
    if re.search(r"[)\]}\"”’»*_`>|]$", last) and not _LIST.match(last):
        inner = last.rstrip("*_\"”’»`)]}>|")
        return bool(inner) and _open_brackets(last) and not inner.endswith((".", "!", "?"))
    words = WORD.findall(last.lower())
    if not words:
        return False
    if words[-1] in _DANGLING and len(words) > 1 and (len(words) > 3 or len(lines) > 1):
        return True
    if _LIST.match(last):
        item = _LIST.sub("", last)
        others = [x for x in lines[:-1] if _LIST.match(x)]
        if _ENDED.search(item[:-1]) or others and all(_STOPPED.search(x.rstrip()) for x in others):
            return True
        return False
    # prose that stops, then a fragment: cut within a sentence
    stopped = list(_ENDED.finditer(text))
    if not stopped:
        return False
    fragment = text[stopped[-1].end() :].strip()
    if "\n" in fragment or not fragment:
        own = last.strip()
        return bool(_ENDED.search(own)) and len(WORD.findall(fragment)) >= 1
    return len(WORD.findall(fragment)) >= 1


# --- Wrong language ---------------------------------------------------------------------------

_BLOCK = re.compile(r"```.*?(?:```|\Z)", re.S)
_SPAN = re.compile(r"`[^`\n]*`|https?://\S+|\S*[/@_=<>{}]\S*")
_WORDS = re.compile(r"(?<![\w-])[^\W\d_]+(?:'[^\W\d_]+)?(?![\w-])")


def prose_of(text: str) -> str:
    """The prose of an answer: without fenced code, code spans, paths and lines of code."""
    if "```" in text:
        text = _BLOCK.sub("\n", text)
    lines = [x for x in text.split("\n") if not _CODE_LINE.match(x)]
    return _SPAN.sub(" ", "\n".join(lines))


def is_wrong_language(instruction: str | None, extra: str | None, output: str) -> bool:
    """Whether an answer's prose is in another language than the question, unasked."""
    prose = prose_of(output)
    words = _WORDS.findall(prose.lower())
    answer, counts = language_of(prose, words)
    if answer is None or counts[answer] < 3:
        return False
    question = instruction if instruction and instruction.strip() else extra
    if not question:
        return False
    asked_prose = prose_of(question) or question
    asked_words = _WORDS.findall(asked_prose.lower())
    wanted, wanted_counts = language_of(asked_prose, asked_words)
    if wanted is None or wanted == answer:
        return False
    if wanted_counts.get(answer, 0) >= wanted_counts[wanted]:
        return False
    own = counts.get(wanted, 0)
    if own * 2 > counts[answer] and answer not in ("zh", "ja", "ko", "ru", "ar", "el", "he", "hi", "th"):
        return False
    asked = WORD.findall(question.lower())
    return not asked_for(asked, answer, question)


KINDS = ("empty_answer", "copied_question", "refusal", "truncated_answer", "wrong_language")


def defect_of(instruction: str | None, extra: str | None, output: str | None) -> str | None:
    """The defect of a pair, or None; the first that holds, in the order of ``KINDS``."""
    if is_empty(output):
        return "empty_answer"
    asked, more = WORD.findall((instruction or "").lower()), WORD.findall((extra or "").lower())
    # the answer can hold both twice, and labels; marks and spacing are no words
    most = 2 * (len(asked) + len(more) + 3) + len(_LABELS)
    answer = WORD.findall(output.lower())
    if len(answer) <= most and is_copy(answer, asked, more):
        return "copied_question"
    if is_refusal(output, f"{instruction or ''} {extra or ''}"):
        return "refusal"
    if is_truncated(output):
        return "truncated_answer"
    if is_wrong_language(instruction, extra, output):
        return "wrong_language"
    return None


def find_defects(
    df: DataFrame, id_column: str = "pair_id", instruction: str = "instruction", extra: str = "input", output: str = "output"
) -> DataFrame:
    """(pair_id, defect) of every defective pair.

    Defects: ``empty_answer`` (null, blank, bare markup, a stand-in), ``copied_question`` (shingles
    contained in the question, and the longest common subsequence covers both), ``refusal`` (every
    sentence aligns to a refusal template or a pleasantry, and one to a refusal),
    ``truncated_answer`` (a notice of cutting, an open code block or bracket, a sentence that
    stops short) and ``wrong_language`` (function words and script of the prose against the
    question's). A copy and a refusal are told by their words; marks, spacing and code spans make no
    difference. The first that holds is given. Null and empty questions make no defect of their
    own; whole texts are read; repeated rows come out repeated; other columns are not read.
    """
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, questions: list, extras: list, answers: list) -> tuple:
            found = [(k, d) for k, q, e, a in zip(keys, questions, extras, answers) if (d := defect_of(q, e, a))]
            return [k for k, _ in found], [d for _, d in found]

        return work

    return map_columns(df, [id_column, instruction, extra, output], make, f"pair_id {kind}, defect string")
