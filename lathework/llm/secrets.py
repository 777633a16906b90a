"""Problem 2: credentials in source code, configuration and logs, found and redacted."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import ahocorasick
from pyspark.sql import DataFrame

from lathework.functions.batches import map_columns
from lathework.llm.crf import Crf

MODEL = Path(__file__).with_name("secrets_crf.json")
MASK = "[REDACTED]"

# --- Lexical tokens ---------------------------------------------------------------------------


@dataclass(slots=True)
class Token:
    """A lexical token of a line: its kind, text and place, and the key it is assigned to."""

    kind: str  # word, key, op, val, user, pass, host, pem
    text: str
    at: int
    end: int
    key: str = ""


_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+?)(?: BLOCK)?-----")
_PEM_END = re.compile(r"-----END [A-Z0-9 ]+-----")
_URL = re.compile(r"([A-Za-z][A-Za-z0-9+.-]{1,20})://([^\s:/@\"'`<>]*):([^\s/\"'`<>]+?)@(?=[\w.\[-]+)")
_URL_PLAIN = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s\"'`<>?]*")
_KEY = re.compile(r"(?:--?)?[^\W\d][\w.-]*|\$\{?\w+\}?")
_OP = re.compile(r"[ \t]*(=>|:=|\?=|\+=|==|=|:)(?![=/])[ \t]*")
_BARE = re.compile(r"[^\s\"'`,;)}\]&]+|[^\s]+")
_WORD = re.compile(r"[^\s\"'`(){}\[\],;]+")
_PADDED = re.compile(r"={1,2}(?=[\s\"'`,;)]|$)(?!\s+[\"'\w])|==?(?=\s+(?:for|if|to|and|as|until|in)\b)")
_SCHEME_WORD = re.compile(r"(Bearer|Basic|Token|Digest|ApiKey|token|bearer|basic)[ \t]+(?=\S)")
_REFERENCE = re.compile(r"\$\{\{?[^}\n]*\}?\}|\{\{[^}\n]*\}\}|\$\([^)\n]*\)|<[^<>\n]{1,60}>|%\w+%")
_GLUED = re.compile(r"-p([^\s\"'`]{4,})")
_QUOTES = "\"'`"
_ELEMENT = re.compile(r"<([A-Za-z][\w.:-]*)(?:\s[^<>]*)?>([^<>\n]+)</\1\s*>")
_OPTION = re.compile(r"--?([A-Za-z][\w.-]*)[ \t]+(?![-|>&])(?=\S)")
_SETTER = re.compile(r"(?:\w+[.:>-]+)*((?:set|with|change|update|reset)_?(\w+)|(?<=\.)(\w+))\([ \t]*(?=[\"'])")


def _closing(line: str, at: int, quote: str) -> int:
    """Where the string that was opened before ``at`` ends."""
    n = len(line)
    while at < n:
        if line[at] == "\\":
            at += 2
            continue
        if line.startswith(quote, at):
            return at
        at += 1
    return n


def lex(line: str, outer: str = "") -> list[Token]:
    """Tokens of a line; ``outer`` is the key that stands on a line above, where one does."""
    out: list[Token] = []
    at, n = 0, len(line)
    key = ""
    urls, calls = "://" in line, "(" in line

    def value(a: int, b: int, name: str) -> None:
        text = line[a:b]
        m = _PEM.search(text)
        if m:
            out.append(Token("pem", m[1], a + m.start(), b, name))
            return
        m = _URL.search(text)
        if m:
            url_parts(m, a, name)
            rest = a + m.end()
            if query := re.search(r"[?&]", line[rest:b]):
                params(rest + query.start(), b)
            return
        if "://" in text and "?" in text:
            params(a + text.index("?"), b)
            return
        m = _SCHEME_WORD.match(text)
        if m:
            out.append(Token("word", m[1], a, a + m.end(1), name))
            a += m.end()
        out.append(Token("val", line[a:b], a, b, name))

    def url_parts(m: re.Match, base: int, name: str) -> None:
        out.append(Token("word", m[1] + "://", base + m.start(), base + m.start(2), name))
        out.append(Token("user", m[2], base + m.start(2), base + m.end(2), name))
        out.append(Token("pass", m[3], base + m.start(3), base + m.end(3), name))

    def params(a: int, b: int) -> None:
        for m in re.finditer(r"[?&]([\w.-]+)=([^&\s\"'`#]*)", line[a:b]):
            out.append(Token("key", m[1], a + m.start(1), a + m.end(1)))
            out.append(Token("op", "=", a + m.end(1), a + m.start(2)))
            out.append(Token("val", m[2], a + m.start(2), a + m.end(2), m[1]))

    while at < n:
        c = line[at]
        if c.isspace() or c in "(){}[],;":
            at += 1
            if c in ",;({[" and not (c in "([" and out and out[-1].kind == "op"):
                key = ""
            continue
        if c == "-" and (m := _PEM.match(line, at)):
            stop = _PEM_END.search(line, m.end())
            end = stop.end() if stop else n
            out.append(Token("pem", m[1], at, end, key or outer))
            at = end
            continue
        if urls and (m := _URL.match(line, at)):
            url_parts(m, 0, key or outer)
            at = m.end()
            continue
        if urls and (m := _URL_PLAIN.match(line, at)):
            out.append(Token("word", "url", at, m.end(), key))
            at = m.end()
            if at < n and line[at] == "?":
                end = at + len(re.match(r"[^\s\"'`]*", line[at:])[0])
                params(at, end)
                at = end
            continue
        if c == "<" and (m := _ELEMENT.match(line, at)) and key_class(m[1]) == "secret":
            a, b = m.span(2)
            text = m[2].strip()
            if text:
                a += m[2].index(text)
                key = m[1]
                out.append(Token("key", key, m.start(1), m.end(1)))
                out.append(Token("op", "=", m.end(1), a))
                value(a, a + len(text), key)
                key = ""
            at = m.end()
            continue
        if c in _QUOTES:
            quote = line[at : at + 3] if line[at : at + 3] in ('"""', "'''") else c
            stop = _closing(line, at + len(quote), quote)
            inside = line[at + len(quote) : stop]
            behind = stop + len(quote)
            if line.startswith("]", behind):
                behind += 1
            after = _OP.match(line, behind) if stop < n else None
            if after and re.fullmatch(r"[\w.$/-]+", inside):
                key = inside
                out.append(Token("key", inside, at + len(quote), stop))
                out.append(Token("op", after[1], after.start(1), after.end(1)))
                at = after.end()
                at = assigned(line, at, key, value, out, n)
                continue
            if not out or out[-1].kind != "op" or line[at - 1] in "([{ ":
                joined = bool(out) and out[-1].text == "+" and len(out) > 1
                if (c == "`" or " " in inside.strip()) and not _SCHEME_WORD.match(inside) and not joined and (_OP.search(inside) or re.search(r"(?i)passw|token|secret", inside)):
                    for t in lex(inside):
                        t.at += at + len(quote)
                        t.end += at + len(quote)
                        out.append(t)
                else:
                    value(at + len(quote), stop, out[-2].key if joined else key)
            at = min(n, stop + len(quote))
            continue
        if c == "-" and (m := _OPTION.match(line, at)) and m[0].rstrip().lower() not in _CUE_WORDS and key_class(m[1]) == "secret":
            key = m[1]
            out.append(Token("key", key, m.start(1), m.end(1)))
            out.append(Token("op", "=", m.end(1), m.end()))
            at = assigned(line, m.end(), key, value, out, n)
            key = ""
            continue
        if calls and (m := _SETTER.match(line, at)) and key_class(name := (m[2] or m[3]).removesuffix("_")) == "secret":
            out.append(Token("key", name, m.start(1), m.end(1)))
            out.append(Token("op", "=", m.end(1), m.end()))
            at = assigned(line, m.end(), name, value, out, n)
            continue
        m = None if line.startswith("-p", at) and _GLUED.match(line, at) else _KEY.match(line, at)
        if m:
            after = _OP.match(line, m.end())
            opens = after and after.end() < n and line[after.end()] in _QUOTES and line.find(line[after.end()], after.end() + 1) > 0
            if after and after[1] in ("=", "==") and len(m[0]) >= 8 and not opens and _PADDED.match(line, m.end()):
                end = m.end() + len(after[1])
                out.append(Token("word", line[at:end], at, end, key))
                at = end
                continue
            if after and not (after[1] == ":" and after.end() < n and line[after.end()] == ":"):
                key = m[0]
                out.append(Token("key", key, at, m.end()))
                if key.isupper() and line.startswith("= ", m.end()):  # set to nothing, in a shell
                    at = m.end() + 2
                    continue
                out.append(Token("op", after[1], after.start(1), after.end(1)))
                at = assigned(line, after.end(), outer if key in ("value", "default") and outer else key, value, out, n)
                continue
        if c in "${<%" and (m := _REFERENCE.match(line, at)):
            out.append(Token("word", m[0], at, m.end(), key))
            at = m.end()
            continue
        if line.startswith("-p", at) and (m := _GLUED.match(line, at)) and re.search(r"\b(?:mysql|mariadb)", line[:at]):
            out.append(Token("word", "-p", at, at + 2, key))
            out.append(Token("word", m[1], at + 2, m.end(), key))
            at = m.end()
            continue
        m = _WORD.match(line, at)
        if not m:
            at += 1
            continue
        text = m[0]
        end = m.end()
        if text[-1:] in ".:!?" and (end >= n or line[end].isspace()) and len(text) > 1 and re.fullmatch(r"[^\W\d_]+[.:!?]", text):
            end -= 1
        out.append(Token("word", line[at:end], at, end, key))
        at = max(end, at + 1) if end == m.end() else m.end()
    return out


def assigned(line: str, at: int, key: str, value: Callable[[int, int, str], None], out: list[Token], n: int) -> int:
    """Read the value behind an assignment; where the line goes on."""
    if at >= n:
        return at
    c = line[at]
    if c in "rbuf" and at + 1 < n and line[at + 1] in "\"'":
        at += 1
        c = line[at]
    if c in _QUOTES:
        quote = line[at : at + 3] if line[at : at + 3] in ('"""', "'''") else c
        stop = _closing(line, at + len(quote), quote)
        value(at + len(quote), stop, key)
        return min(n, stop + len(quote))
    if c in "{[(,":
        return at
    if m := _REFERENCE.match(line, at):
        out.append(Token("val", m[0], at, m.end(), key))
        return m.end()
    if _PEM.match(line, at):
        return at
    if m := _SCHEME_WORD.match(line, at):
        out.append(Token("word", m[1], at, m.end(1), key))
        at = m.end()
    spaced = line[max(0, at - 2) : at].endswith((" ", "\t"))
    m = re.compile(r"[^\s]+").match(line, at) if spaced or "=" == line[at - 1 : at] and "(" not in line[:at] and "?" not in line[:at] else _BARE.match(line, at)
    if not m:
        return at
    end = m.end()
    if re.match(r"[\w.]+\(", m[0]):  # a call: up to its bracket
        end = at + m[0].index("(") + 1
        out.append(Token("val", line[at:end], at, end, key))
        return end
    while end > at + 1 and line[end - 1] in ",;" or end > at + 1 and line[end - 1] in ")]}\"'" and line[end - 1] not in m[0][:-1]:
        end -= 1
    value(at, end, key)
    return end


# --- Features ---------------------------------------------------------------------------------

# Words in names of credentials, of digests and ids, and endings of plain settings.
_SECRET_NAME = re.compile(
    r"pass(?:w(?:or)?d|phrase|code)?(?![a-z])|passwort|(?<![a-z])pwd|(?<![a-z])pw(?![a-z])|secret(?!less)|token|(?:api|access|private|secret|signing|service|encryption|master|"
    r"deploy|account|auth|client|ssh|storage|shared|license|hmac|jwt)[_.-]?key|apikey|cred(?:ential)?s?(?![a-z])|(?<![a-z])auth(?:orization)?(?![a-z])|"
    r"(?<![a-z])(?:signing|signer|bearer|cookie|x-auth|kennwort|contrase(?:ña)?|clave|mdp|passe|psk|pem|otp|pin)(?![a-z])|(?<![a-z])key$"
)
_DIGEST_NAME = re.compile(
    r"commit|integrity|checksum|digest|etag|hash|(?<![a-z])sha\d*|md5|trace|span|request|fingerprint|revision|(?<![a-z])rev(?![a-z])|version|build|uuid|guid|"
    r"(?<![a-z])id$|_id(?![a-z])|public|(?<![a-z])ref|nonce|crc|serial|tag|image|cert(?:ificate)?(?![a-z])|(?<![a-z])ca(?![a-z])|salt"
)
_PLAIN_END = re.compile(
    r"(?:file|path|dir|env|name|ref|url|uri|host|port|user|username|limit|bytes|count|size|ratio|seconds|ms|interval|ceiling|floor|depth|budget|ttl|timeout|expiry|length|"
    r"type|kind|window|policy|id|enabled|required|header|prefix|hint|field|label|pattern|rotation|age|version|algorithm|method|provider|store|manager)s?$"
)
_FILE_NAME = re.compile(r"(?i)\.(?:cfg|conf|ini|ya?ml|json|toml|txt|md|log|sh|py|js|ts|go|rb|tf|xml|sql|lock)$")
_REFERENCES = re.compile(
    r"^(?:\$\{?|\{\{|<%|%\w+%|\$\(|@@|var\.|local\.|data\.|module\.|env\.|self\.|config\.|settings\.|secrets?\.|vault[:./]|os\.|process\.|getenv|getpass|input\(|ENV\[|"
    r"None$|null$|nil$|true$|false$|undefined$|!ref|!sub|arn:|ssm:|op://|secretmanager|keyring|file:|ref\+)|\(\)?$|^\w+(?:\.\w+)+\("
)
_PLACEHOLDER = re.compile(
    r"(?i)^(?:<.*>|\[.*\]|\{.*\}|x{3,}|\*{2,}|\.{2,}|-+|_+|\?+|#+|•+|…)$|your[-_ ]|[-_ ]here$|change[-_ ]?me|replace[-_ ]?(?:me|this|with)?|place[-_ ]?holder|redacted|example|"
    r"dummy|insert|to[-_ ]?be[-_ ]|^(?:todo|tbd|none|null|nil|n/a|empty|secret|password|passwd|pass|token|key|test|foo|bar|string|str|bytes|int|bool|masked|hidden|removed|undefined|"
    r"optional|required|required,|pwd|passphrase|credentials?)$|^x+$|fixme|sample|not[-_ ]?set|unset|masked|\bfake\b|enter[-_ ]"
)
_PREFIX = re.compile(
    r"^(?:gh[oprsu]_|github_pat_|glpat-|xox[abeoprs]-|sk_(?:live|test)_|pk_live_|rk_live_|sk-|hf_|npm_|pypi-|SG\.|eyJ[\w-]|hvs\.|hvb\.|AIza|A[KS]IA[A-Z0-9]|ya29\.|dop_v1_|dckr_pat_|"
    r"shp(?:at|ss)_|sq0|EAAC|lin_api_|key-|whsec_|tfp_|nvapi-|rubygems_|AGE-SECRET-KEY)"
)
_HEX = re.compile(r"^(?:0x)?[0-9a-fA-F]+$")
_UUID = re.compile(r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
_SHA = re.compile(r"(?i)^(?:sha\d{1,3}|md5|blake2?[bs]?\d*)[:-]")
_PATH = re.compile(r"^(?:~|\.{1,2})?/[\w./-]+$|^[A-Za-z]:\\")
_MAIL = re.compile(r"^(?:mailto:)?[\w.+-]+@[\w-]+(?:\.[\w-]+)+(?:[:/.]\S*)?$")
_EXTENSION = re.compile(r"\.[A-Za-z]{1,5}$")
_NUMBER = re.compile(r"^[-+]?\d[\d_.,]*[a-zA-Z%]{0,2}$")
_B64 = re.compile(r"^[A-Za-z0-9+/]{4,}={0,2}$")


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


@lru_cache(maxsize=1 << 16)
def key_class(name: str) -> str:
    if not name:
        return "none"
    name = name.rsplit("/", 1)[-1]
    if _FILE_NAME.search(name):
        return "plain"
    low = re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name).lower().strip("-$\"'{}_") if not name.isupper() else name.lower()
    secret = _SECRET_NAME.search(low)
    if secret and "public" not in low:
        if _PLAIN_END.search(low) and not low.endswith(("key", "token", "password")):
            return "plain"
        return "secret"
    if _DIGEST_NAME.search(low):
        return "digest"
    if _PLAIN_END.search(low):
        return "plain"
    return "other"


def value_class(text: str, key: str = "") -> str:
    """The shape of a value: a reference, a placeholder, a digest, a known prefix or a mix of characters."""
    if not text:
        return "empty"
    if len(text) > 1 and len(set(text)) == 1 or not any(map(str.isalnum, text)):
        return "mask"
    if "@" in text and _MAIL.match(text):
        return "mail"
    if _REFERENCES.search(text):
        return "ref"
    if _PREFIX.match(text) and len(text) >= 12:
        return "prefix"
    if _PLACEHOLDER.search(text):
        return "placeholder"
    if _UUID.match(text):
        return "uuid"
    if _SHA.match(text) or "@sha" in text:
        return "sha"
    if _NUMBER.match(text):
        return "number"
    if _PATH.match(text) and (_EXTENSION.search(text) or ("." in text or text.count("/") > 1) and not re.search(r"[A-Z0-9]{6}", text)):
        return "path"
    if _HEX.match(text) and len(text) >= 16:
        return "hex32" if len(text) == 32 else "hex40" if len(text) == 40 else "hex64" if len(text) == 64 else "hex"
    if re.fullmatch(r"[A-Z][A-Z0-9_]+", text) and (key and text.strip("_") in key.upper().replace("-", "_") or "_" in text):
        return "constant"
    if " " in text.strip():
        return "phrase"
    lower, upper, digit = any(map(str.islower, text)), any(map(str.isupper, text)), any(map(str.isdigit, text))
    special = bool(re.search(r"[^A-Za-z0-9_./+=-]", text))
    if re.fullmatch(r"[a-z]+(?:[-_.][a-z]+)+", text):
        return "words" if "-" in text else "dotted"
    if len(text) >= 16 and (lower and upper and digit):
        return "random"
    if _B64.match(text) and text.endswith("=") and len(text) >= 8:
        return "base64"
    kinds = "a" * lower + "A" * upper + "0" * digit + "!" * special
    size = "s" if len(text) < 6 else "m" if len(text) < 20 else "l"
    return f"{kinds}:{size}"


_CUE_WORDS = frozenset(
    "password passwort passphrase passwd pwd pass token secret key bearer basic login credential credentials kennwort contraseña clave mdp passe apikey -p -u --user --password --token "
    "authorization auth sshpass cookie".split()
)


# Calls that take a user and a password by their places.
_LOGIN_CALLS = frozenset("connect login authenticate auth signin sign_in logon basicauth httpbasicauth basic_auth httpdigestauth client session connection createconnection create_connection dial open_session simpleclient".split())


# What may stand between the word for a login and its user.
_IS = frozenset("is are was for : = ist est es".split())


def _call_of(token: Token) -> bool:
    """Whether a token names a call that takes a password by its place."""
    name = re.split(r"[.:>]+", token.text.rstrip("("))[-1].lower()
    return name in _LOGIN_CALLS


def features_of(tokens: list[Token], comment: bool = False) -> list[list[str]]:
    """Features of every token: its kind, shape, key and neighbours, and its place in a call that logs in."""
    kinds = [t.kind for t in tokens]
    keys = [key_class(t.key) if t.kind not in ("key", "op") else "" for t in tokens]
    shapes = [value_class(t.text, t.key) if t.kind in ("val", "word", "pass", "user") else "" for t in tokens]
    out = []
    place = -1  # of an argument within such a call
    for i, t in enumerate(tokens):
        if t.kind in ("word", "val", "key") and _call_of(t):
            place = 0
        elif place >= 0 and t.kind != "op":
            place = place + 1 if t.kind == "val" or t.kind == "word" and t.text.isdigit() else -1
        own = ["bias", f"kind={t.kind}"]
        if t.kind == "pem":
            own.append("pem=private" if "PRIVATE" in t.text else "pem=other")
        elif t.kind == "key":
            own.append(f"name={key_class(t.text)}")
        elif t.kind != "op":
            shape = shapes[i]
            own += [f"shape={shape}", f"kind+shape={t.kind}+{shape}", f"for={keys[i]}", f"kind+for+shape={t.kind}+{keys[i]}+{shape}"]
            own.append(f"len={min(len(t.text) // 4, 10)}")
            if t.kind in ("val", "word"):
                own.append(f"entropy={t.kind}{int(_entropy(t.text))}")
            before = tokens[i - 1].text.lower().strip(":=\"'") if i else "^"
            two = tokens[i - 2].text.lower() if i > 1 else "^"
            if t.kind in ("word", "val"):
                cue = before if before in _CUE_WORDS else two if two in _CUE_WORDS and before in ("is", "=", ":", "ist", "est", "es", "of", "for", "/") else ""
                if not cue and before == "/":
                    cue = next((f"login/{tokens[j + 1].text.lower() in _IS}" for j in range(max(0, i - 6), i - 1) if tokens[j].text.lower().rstrip(":") in ("login", "account", "credentials")), "")
                if cue:
                    own += ["cue", f"cue={cue}", f"cue+shape={shape}"]
                if before in ("bearer", "basic"):
                    own.append(f"scheme+shape={shape}")
            if place > 0:
                own += [f"arg={min(place, 4)}", f"arg+shape={min(place, 4)}+{shapes[i]}", f"arg+last={i + 1 == len(tokens)}"]
            if i and kinds[i - 1] == "word" and tokens[i - 1].text == "+":
                own.append("joined")
        if i == 0:
            own.append("first")
        else:
            own.append(f"prev={kinds[i - 1]}")
        out.append(own)
    return out


# --- Finding ----------------------------------------------------------------------------------

# What every line that can hold a credential has in it: a part of a name of class "secret" (the
# literal stems of _SECRET_NAME), a cue word of the features, a url or block, or a known prefix.
_STEMS = (
    "pass pwd pw secret token key cred auth signing signer bearer cookie kennwort contrase clave mdp psk pem otp pin".split()
)
_PREFIXES = (
    "ghp_ gho_ ghs_ ghr_ ghu_ github_pat_ glpat- xox sk_live_ sk_test_ pk_live_ rk_live_ sk- hf_ npm_ pypi- sg. eyj hvs. hvb. aiza akia asia ya29. dop_v1_ dckr_pat_ "
    "shpat_ shpss_ sq0 eaac lin_api_ whsec_ tfp_ nvapi- rubygems_"
).split()
_CUES = sorted({*_STEMS, *(w for w in _CUE_WORDS if not w.startswith("-")), *_PREFIXES, *(f"{call}(" for call in _LOGIN_CALLS), "account", "curl", "wget", "mysql", "mariadb", "redis-cli", "smbclient", "htpasswd", "ldapsearch", "://", "-----begin"})
_SHORT_STEMS = frozenset("pw pwd pem otp pin psk mdp".split())
_PASS_AT = re.compile(r"(?i:pass(?:w(?:or)?d|wort|phrase|code|e)?)(?![a-z])")
_PREFIX_SET = frozenset(_PREFIXES)


def _at_name(text: str, cue: str, start: int, end: int) -> bool:
    """Whether a stem or prefix stands where a name or value can have it, as the features ask.

    Short stems must be whole parts of a name, prefixes begin a token; ``pass`` goes with its compounds.
    """
    if cue in _SHORT_STEMS:
        before, after = text[start - 1 : start], text[end : end + 1]
        left = not before.isalpha() or before.islower() and text[start].isupper()
        return left and (not after.isalpha() or after.isupper() and text[end - 1].islower())
    if cue in _PREFIX_SET:
        return not (start and text[start - 1].isalnum())
    return cue != "pass" or bool(_PASS_AT.match(text, start))


# Values that need no cue: tokens of eight characters or more with small letters, capitals and digits, or of
# sixteen or more with letters and digits. Matched from the first digit of a token on, in one pass.
_MIXED = re.compile(r"(?<![^\s\"'`,;()<>\[\]{}=:])[^\s\"'`,;()<>\[\]{}=:\d]*+\d[^\s\"'`,;()<>\[\]{}]*+")


def _dense(text: str) -> bool:
    """Whether a token is a mix that words, paths and numbers are not."""
    n = len(text)
    if n < 8:
        return False
    small, large = not text.isupper(), not text.islower()
    return small and large and text.upper() != text.lower() and any(map(str.islower, text)) and any(map(str.isupper, text)) or n >= 16 and any(map(str.isalpha, text))


#: Tokens to both sides of one that can be a value that are labelled with it; features look back six at most.
REACH = 8


def _segments(tokens: list[Token]) -> list[tuple[int, int]]:
    """The parts of a line that the model labels: all around tokens that any feature of a value speaks for.

    A token can be a value if it is a password or block by its form, its key is a secret's, a cue
    word or name stands before it, it is an argument of a call that logs in, or its characters are mixed.
    """
    n, call, out = len(tokens), -1, []
    cue = slash = -9  # where the last of either stands
    for i, t in enumerate(tokens):
        word = t.text.lower().strip(":=\"'")
        if t.kind in ("word", "val", "key") and _call_of(t):
            call = 0
        elif call >= 0 and t.kind != "op":
            call = call + 1 if t.kind == "val" or t.kind == "word" and t.text.isdigit() else -1
        likely = t.kind in ("pass", "pem")
        if not likely and t.kind not in ("key", "op"):
            likely = call > 0 or i - cue <= 3 or i - slash <= 6 and t.text == "/" or bool(t.key) and key_class(t.key) == "secret" or _dense(t.text) and value_class(t.text, t.key) not in ("path", "dotted", "words", "uuid", "sha")
            likely = likely or bool(i) and tokens[i - 1].text[-1:] in ":=" and key_class(tokens[i - 1].text.strip(":=")) == "secret" or bool(_PREFIX.match(t.text)) or t.text[-1:] == "=" and len(t.text) >= 8
        if word in _CUE_WORDS:
            cue = i
        if word in ("login", "account", "credentials"):
            slash = i
        if likely:
            low, high = max(0, i - REACH), min(n, i + REACH + 1)
            if out and low <= out[-1][1]:
                out[-1] = (out[-1][0], high)
            else:
                out.append((low, high))
    return out


_NAME_LINE = re.compile(r"^\s*-?\s*name:\s*[\"']?([\w.-]+)[\"']?\s*$")
_BARE_KEY = re.compile(r"^\s*[\"']?([\w.-]+)[\"']?\s*[:=]\s*(?:[|>][+-]?|\\)?\s*$")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for cue in _CUES:
        machine.add_word(cue, cue)
    machine.make_automaton()
    return machine


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return Crf.from_dict(json.loads(MODEL.read_text()))


def _lex_below(line: str, key: str) -> list[Token] | None:
    """Tokens of a line that only holds the value of the name above, as if both stood on one line."""
    m = re.fullmatch(r"\s*(?:-\s+)?(\"[^\"]+\"|'[^']+'|[^\s\"'`]+)[,;]?\s*", line)
    if not m or _OP.search(m[1]) and m[1][0] not in _QUOTES and not m[1].endswith("="):
        return None
    if m[1][0] in "#{[(" or m[1].startswith(("//", "-----")):
        return None
    head = f"{key} = "
    tokens = lex(head + m[1])
    shift = m.start(1) - len(head)
    for t in tokens:
        t.at, t.end = max(0, t.at + shift), max(0, t.end + shift)
    return tokens


def spans_of(text: str, crf: Crf) -> list[tuple[int, int, int]]:
    """(line_no, start, end) of every credential's value in a text, in order.

    Every line is labelled by the model that holds a stem of a name, a cue or a prefix (found by an
    automaton over all at once), a token that is a mix of characters (:func:`_dense`), or the value
    of a bare name on the line above. A span begins with a token labelled B and takes in those
    labelled I; of long lines the parts around tokens that can be values are labelled (:func:`_segments`).
    A private key spans its block up to the END line.
    """
    if not text:
        return []
    low = text.lower()
    machine = _automaton()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    marked: set[int] = set()
    below: set[int] = set()
    named: set[int] = set()
    stop = -1
    for end, cue in machine.iter(low):
        if end > stop and _at_name(text, cue, end + 1 - len(cue), end + 1):
            start = text.rfind("\n", 0, end) + 1
            stop = text.find("\n", end)
            stop = len(text) if stop < 0 else stop
            marked.add(start)
            if stop < len(text):
                line = text[start:stop].rstrip("\r")
                if (m := _BARE_KEY.match(line)) and key_class(m[1]) == "secret":
                    below.add(stop + 1)
                elif (m := _NAME_LINE.match(line)) and key_class(m[1]) == "secret":
                    named.add(stop + 1)
    marked |= below | named
    marked |= {text.rfind("\n", 0, m.start()) + 1 for m in _MIXED.finditer(text) if _dense(m[0])}
    out: list[tuple[int, int, int]] = []
    skip = -1
    line_no, counted = 1, 0
    for start in sorted(marked):
        if start < skip:
            continue
        stop = text.find("\n", start)
        stop = len(text) if stop < 0 else stop
        line = text[start:stop].rstrip("\r")
        line_no += text.count("\n", counted, start)
        counted = start
        outer = ""
        if start:
            above_start = text.rfind("\n", 0, start - 1) + 1
            above = text[above_start : start - 1].rstrip("\r")
            m = _NAME_LINE.match(above) or _BARE_KEY.match(above)
            outer = m[1] if m else ""
        tokens = _lex_below(line, outer) if start in below else None
        if tokens is None:
            tokens = lex(line, outer)
        if not tokens:
            continue
        if (block := tokens[-1]).kind == "pem":  # the lines of a block hold nothing else, a public one's neither
            m = _PEM_END.search(text, start + block.at)
            skip = m.end() if m else max(stop, _pem_stop(text, stop))
        labelled = [(t, label) for low, high in _segments(tokens) for t, label in zip(tokens[low:high], crf.decode(features_of(tokens[low:high])))]
        for token, label in labelled:
            if label == "O" or token.end <= token.at:
                continue
            a, b = start + token.at, start + token.end
            if token.kind == "pem":
                m = _PEM_END.search(text, a)
                b = m.end() if m else max(b, _pem_stop(text, stop))
                skip = b
            if label == "I" and out and out[-1][0] == line_no and not text[out[-1][2] : a].strip("\"'+ \t"):
                out.append((line_no, a, b))
            else:
                out.append((line_no, a, b))
    return out


_PEM_LINE = re.compile(r"[ \t]*(?:[A-Za-z0-9+/=\\n]+|[A-Z][\w-]+: .*)?[ \t\r]*(?:\n|\Z)")


def _pem_stop(text: str, at: int) -> int:
    """The end of a block without an END line: the last line of encoded text."""
    end = at
    at = min(len(text), at + 1)
    while at < len(text) and (m := _PEM_LINE.match(text, at)) and m.end() > at and m[0].strip():
        end = at + len(m[0].rstrip())
        at = m.end()
    return end


def redact(text: str | None, crf: Crf, mask: str = MASK) -> str | None:
    """The text with only the values of credentials replaced; a key block keeps its lines."""
    if not text:
        return text
    parts, last = [], 0
    for _, a, b in spans_of(text, crf):
        if a < last:
            continue
        block = text[a:b]
        if block.startswith("-----BEGIN"):
            head = _PEM.match(block)
            tail = _PEM_END.search(block)
            inner = block[head.end() : tail.start() if tail else len(block)]
            fresh = head[0] + re.sub(r"[A-Za-z0-9+/=]{8,}", mask, inner) + (tail[0] if tail else "")
        else:
            fresh = mask
        parts += [text[last:a], fresh]
        last = b
    return "".join([*parts, text[last:]])


def _fields(df: DataFrame, id_column: str, fields: tuple[str, ...], make, schema: str) -> DataFrame:
    return map_columns(df, [id_column, *fields], make, schema)


def find_secrets(
    df: DataFrame, id_column: str = "pair_id", fields: tuple[str, ...] = ("input", "output"), model: Crf | None = None
) -> DataFrame:
    """(pair_id, field, line_no, start, end) of every credential's value.

    ``line_no`` counts from 1, ``start`` and ``end`` are offsets in code points of what is redacted.
    Tokens of a line are labelled by a linear-chain conditional random field over shape and
    context features, and decoded by Viterbi. Passwords, keys, tokens and private keys count, also
    encoded, in urls and comments; placeholders, references, public keys, certificates, digests and
    ids do not. Null and empty texts give no rows; whole texts are read; repeated rows come out
    repeated; other columns are not read. The model (a few thousand weights) goes with the task.
    """
    kind = df.schema[id_column].dataType.simpleString()
    raw = (model or default_model()).as_dict()

    def make() -> Callable[..., tuple]:
        crf = Crf.from_dict(raw)

        def work(keys: list, *columns: list) -> tuple:
            rows = [
                (key, name, line, a, b)
                for name, texts in zip(fields, columns)
                for key, text in zip(keys, texts)
                for line, a, b in spans_of(text, crf)
            ]
            return tuple(map(list, zip(*rows))) if rows else ([], [], [], [], [])

        return work

    return _fields(df, id_column, fields, make, f"pair_id {kind}, field string, line_no int, start int, end int")


def redact_secrets(
    df: DataFrame, id_column: str = "pair_id", fields: tuple[str, ...] = ("input", "output"), model: Crf | None = None
) -> DataFrame:
    """The id and the fields of every row, with the values of credentials replaced by a mask.

    Same rules as :func:`find_secrets`. Rows without credentials, null and empty texts come out as they are.
    """
    kind = df.schema[id_column].dataType.simpleString()
    raw = (model or default_model()).as_dict()

    def make() -> Callable[..., tuple]:
        crf = Crf.from_dict(raw)
        return lambda keys, *columns: (keys, *[[redact(t, crf) for t in texts] for texts in columns])

    schema = ", ".join([f"{id_column} {kind}", *[f"{f} string" for f in fields]])
    return _fields(df, id_column, fields, make, schema)
