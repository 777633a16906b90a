"""Training of the credential model on invented lines: ``python -m lathework.llm.train_secrets``.

Every line is made from a form, a name and a value, with the places of credentials marked, so the
labels are exact. Nothing is read from any table. The seed is fixed; the weights are written beside
this module.
"""

from __future__ import annotations

import base64
import json
import random
import string

from lathework.llm.crf import Crf, train
from lathework.llm.secrets import MODEL, features_of, lex

OPEN, CLOSE = "\x01", "\x02"
SECRET_NAMES = (
    "password passwd pwd db_password smtp_password root_pw admin_pass passphrase keystore_password postgres_password api_key apikey access_key secret_key signing_key "
    "service_key encryption_key client_secret webhook_secret app_secret auth_token access_token bot_token registry_token refresh_token session_token private_key secret token "
    "credentials jwt_secret license_key account_key deploy_key signing auth redis_password mysql_root_password"
).split()
DIGEST_NAMES = "commit integrity checksum etag image_digest request_id trace_id sha256 fingerprint revision build_id digest span_id session_id correlation_id uuid content_hash version ref public_key cert_sha".split()
PLAIN_NAMES = "service name host port user path region namespace timeout retries image flush_limit poll_ms cache_bytes token_window_limit max_tokens token_count key_size password_file secret_name key_path token_ttl auth_url password_env credentials_path secret_store token_limit secret_ref password_policy key_id".split()
URL_NAMES = "dsn database_url broker upstream index_url url connection redis_url amqp_url proxy uri".split()
SYLLABLES = "ba be bi bo da de di do fa fe ga go ha ka ke ki la le li lo ma me mi mo na ne no pa pe po ra re ri ro sa se si so ta te ti to va ve wa we ya za ze zi tor mon lin ker dal fen gol".split()
PROSE = (
    "the token window keeps its budget below the limit|every secretless store carries entries under sustained load|rotate the certificate behind the proxy|"
    "the key is stored in the vault and not in the file|set the password in the form, then sign in|tokens are counted per request|ask the team for a token|"
    "the passphrase is asked for at start|a secret manager hands out credentials at run time|the api key must not be shared|no password is needed here|"
    "reset the password with the link in the mail|see the docs on token rotation and key handling|this token expires after one hour|the key was lost last week|"
    "basic settings are described below|bearer tokens are sent in the header|my key does not work here|the secret is to keep the window small"
).split("|")


class Maker:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def pick(self, items):
        return self.rng.choice(items)

    def chars(self, alphabet: str, low: int, high: int | None = None) -> str:
        return "".join(self.pick(alphabet) for _ in range(self.rng.randint(low, high or low)))

    def word(self) -> str:
        return "".join(self.pick(SYLLABLES) for _ in range(self.rng.randint(2, 3)))

    def secret(self) -> str:
        r = self.rng
        alnum, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
        kind = r.randrange(21)
        if kind == 0:
            return self.pick(("ghp_", "gho_", "ghu_", "ghs_")) + self.chars(alnum, 36)
        if kind == 1:
            return "sk_live_" + self.chars(alnum, 24)
        if kind == 2:
            return "xoxb-" + self.chars(string.digits, 11) + "-" + self.chars(string.digits, 12) + "-" + self.chars(alnum, 24)
        if kind == 3:
            return "AKIA" + self.chars(string.ascii_uppercase + "234567", 16)
        if kind == 4:
            return "eyJ" + self.chars(alnum + "-_", 17) + ".eyJ" + self.chars(alnum + "-_", 60) + "." + self.chars(alnum + "-_", 43)
        if kind == 5:
            return "SG." + self.chars(alnum, 22) + "." + self.chars(alnum + "-_", 43)
        if kind == 6:
            return self.pick(("hf_", "npm_", "glpat-", "hvs.", "AIza", "dckr_pat_", "pypi-")) + self.chars(alnum, 20, 36)
        if kind == 7:
            return self.chars(hexes, 32)
        if kind == 8:
            return self.chars(alnum + "+/", 40)
        if kind == 9:
            return self.chars(alnum + "-_", 34)
        if kind == 10:
            return self.chars(string.ascii_lowercase, 8, 10)
        if kind == 11:
            return self.word() + self.chars(string.digits, 2, 4)
        if kind == 12:
            return self.word().capitalize() + self.chars(string.digits, 4) + self.pick("!?.*")
        if kind == 13:
            return "P@" + self.chars(alnum, 8)
        if kind == 14:
            return "-".join(self.word() for _ in range(3))
        if kind == 15:
            return self.chars(alnum + "!*^%$_", 12)
        if kind == 16:
            return base64.b64encode(self.chars(alnum + "@!", 8, 14).encode()).decode()
        if kind == 17:
            return self.chars(alnum, 12, 16)
        if kind == 18:
            return self.chars(hexes, 40)
        if kind == 19:
            return self.pick((self.word()[:4] + "-", "key-", "prod-", "tok_")) + self.chars(hexes, 24, 28)
        return self.chars(alnum, 16, 24)

    def no_secret(self, name: str) -> str:
        upper = name.upper().replace("-", "_").replace(".", "_")
        return self.pick(
            (
                "REPLACE_ME", "changeme", "changeme-placeholder", f"YOUR_{upper}_HERE", f"<your-{name.replace('_', '-')}>", "********", "xxxxxxxx", "", "TODO", "null",
                f"${{{upper}}}", f"${upper}", f"{{{{ vault_{name} }}}}", f"${{{{ secrets.{upper} }}}}", f"<{upper}>", "...", "example-" + name, "redacted", "placeholder",
                f"/etc/{self.word()}/{self.word()}.txt", "your-token-here", "not-set", "dummy", f"vault:{self.word()}/{self.word()}#{name}", upper, f"var.{name}", f"data.{self.word()}.{name}",
            )
        )

    def digest(self) -> str:
        hexes = "0123456789abcdef"
        return self.pick(
            (
                self.chars(hexes, 40), "sha256:" + self.chars(hexes, 64), "sha384-" + self.chars(string.ascii_letters + string.digits + "+/", 64), self.chars(hexes, 64), self.chars(hexes, 32),
                "-".join(self.chars(hexes, n) for n in (8, 4, 4, 4, 12)), self.chars(hexes, 7, 12), str(self.rng.randint(1, 10**9)),
            )
        )

    def plain(self) -> str:
        return self.pick((self.word() + "-" + self.word(), str(self.rng.randint(1, 999)), "/srv/" + self.word() + "/" + self.word() + ".yaml", "true", self.word(), self.word() + ".example.com", self.word().upper()))

    def spell(self, name: str) -> str:
        style = self.rng.randrange(6)
        if style == 0:
            return name.upper()
        if style == 1:
            return name.replace("_", "-")
        if style == 2:
            head, *tail = name.split("_")
            return head + "".join(t.capitalize() for t in tail)
        if style == 3:
            return f"{self.word()}.{self.word()}.{name}"
        return name

    def assign(self, name: str, value: str, marked: bool) -> tuple[str, str]:
        """A line that assigns ``value`` to ``name``, and the key on the line above."""
        v = f"{OPEN}{value}{CLOSE}" if marked else value
        spelled = self.spell(name)
        bare = not any(c in value for c in " \"'`#;,") and value
        forms = [
            (f'{spelled} = "{v}"', ""), (f"{spelled} = '{v}'", ""), (f'{spelled}: "{v}"', ""), (f'  "{name}": "{v}",', ""), (f'"{name}" : "{v}",', ""), (f'  {name}   =   "{v}"  # {self.word()} {self.word()}', ""),
            (f"{name.upper()}='{v}'", ""), (f'client = connect("{self.word()}.example.net", user="{self.word()}", {name}="{v}")', ""), (f'    "auth": {{"{self.word()}": {self.rng.randint(1, 999)}, "{name}": "{v}"}},', ""),
            (f"      value: '{v}'", name.upper()), (f'  value: "{v}"', name), (f'{name} := "{v}"', ""), (f'const {spelled.replace(".", "_").replace("-", "_")} = "{v}";', ""), (f'self.{name} = "{v}"', ""), (f'config["{name}"] = "{v}"', ""), (f'os.environ["{name.upper()}"] = "{v}"', ""),
            (f"`{name}={v}`", "") if bare else (f'{name}="{v}"', ""), (f'# {name}: "{v}"', ""), (f'// old {name} = "{v}"', ""),
        ]
        if bare:
            forms += [
                (f"{spelled} = {v}", ""), (f"{spelled}={v}", ""), (f"  {name}: {v}", ""), (f"export {name.upper()}={v}", ""), (f"{self.word()} login --{name.replace('_', '-')}={v} {self.word()}.example.org", ""),
                (f"docker run -d -e {name.upper()}={v} {self.word()}:{self.rng.randint(1, 99)}", ""), (f"spring.{self.word()}.{name}: {v}", ""), (f"DEBUG connecting with {name}={v} retry={self.rng.randint(1, 99)}", ""),
                (f"# TODO remove, {name}={v}", ""), (f"GET https://{self.word()}.test/v1/{self.word()}?limit={self.rng.randint(1, 99)}&{name}={v} 200", ""), (f"      value: {v}", name.upper()), (f"--{name.replace('_', '-')} {v}", "") if marked and not value.startswith("-") else (f"{name}={v}", ""),
                (f"2024-01-0{self.rng.randint(1, 9)} INFO {name}: {v} accepted", ""),
            ]
        return self.pick(forms)

    def noise(self) -> str:
        """A line without any credential that holds words, numbers and marks like those of lines with one."""
        r, w = self.rng, self.word
        ident = self.pick((self.chars(string.ascii_uppercase, 1, 3) + self.chars(string.digits, 6, 9), self.chars(string.digits, 8, 12), self.chars(string.ascii_uppercase + string.digits, 8, 10)))
        stem = self.pick(("pinned", "passing", "overlapping", "keyed", "signed", "tokenized", "authored", "credited", "compass", "bypass", "keyboard", "monkey", "secretary", "mapping", "passport", "spinning"))
        code = self.pick((f"v{r.randint(1, 9)}Beta{r.randint(1, 99)}", f"Node{r.randint(1, 99)}Pool", f"Model{self.chars(string.digits, 2, 4)}Xl", f"HTTP2Server", f"Base64Decoder", f"Utf8String", f"Md5Sum"))
        return self.pick(
            (
                f"The image is {w()}-{w()}@sha256:{self.chars('0123456789abcdef', 24)} in build {self.chars(string.digits, 4)}-{r.randint(10, 99)}.", f"Prompt shows {w()}@{w()}-{r.randint(1, 9)}:~$ on each host.", f"VERSION {r.randint(1, 999)} MOVED IT INTO `/{w().upper()}/{w().upper()}-{w().upper()}.TOML`.",
                f"see https://{w()}.test/{w()}/{self.chars(string.ascii_letters + string.digits, 6, 12)} and {w()}/{w().capitalize()}{r.randint(1, 99)}.py:{r.randint(1, 999)}", f"  {self.pick(('tls.key', 'ca.crt', 'password', 'api_key', w()))}: {self.pick(('|', '>-', '|-', '>'))}", f"MAIL {w().upper()}.{w().upper()}{r.randint(10, 99)}@{w().upper()}.TEST", f"{self.pick(('mailto:', '', 'Contact: ', 'write to ', 'by '))}{w()}.{w()}@{w()}.{w()}.example{self.pick(('', '.', '.net', '.ORG'))} {w()}s the {stem} {w()}.", f"git@{w()}.test:{w()}/{w()}-{w()}.git", f"mail {w()}.{w()}{r.randint(10, 99)}@{w()}.test or port {w()}.test:{r.randint(1000, 9999)}",
                f'raise ValueError("{stem} {w()} {w()} too large")', f'    throw new Error("{stem} {w()} is missing");', f"Passport: {ident}", f"# test applicant: Passport: {ident}", f"The row that breaks {w()}-{w()} has Passport: {ident} in it.", f"Tax id {ident}, order no. {r.randint(10**6, 10**8)}.",
                f'  "service": "{w()}-{w()}",', f'"{w()}": "{stem} {w()}",', f"I'm sorry, but I can't help with {w()}-{w()}.", f"It isn't {stem}, and {w()} doesn't accept {r.randint(1, 999)} calls. [truncated]", f"**{w().capitalize()}-{w()}** keeps the {stem} {w()} below {r.randint(1, 99)}.",
                f"Use `--{w()}-{w()}-size` with {stem} {w()}s.", f"Address: {w().capitalize()} {r.randint(1, 300)}, {self.chars(string.digits, 5)} {w().capitalize()}. Contact: {w()}@{w()}.test.", f"{code} and {w().capitalize()}{r.randint(1, 9)}{w()} are {stem} in {w()}.", f"import {w()}.{code}", f"class {code}({w().capitalize()}):", f"see {w()}/{code}/{w()}{r.randint(1, 99)}.md",
                f"print('{code}', 'x')", f"{w()} = {code}({w()}, {r.randint(1, 99)})", f"The {stem} {w()} of {w()}-{w()} returned {r.randint(1, 999)}; {w()} key frames are fine.", f"{w()}。{w().capitalize()}-{w()} {stem}", f'log.info("{stem} %s at {code}", {w()})', f"The driver's licence {ident} is {stem}, please mask it.",
            )
        )

    def call(self) -> str:
        """A call with arguments by their places, the password among them in some."""
        r, w = self.rng, self.word
        alnum = string.ascii_letters + string.digits
        strong = self.pick((self.chars(alnum, 9, 20), self.chars(alnum + "!*^%$_", 10, 16), w().capitalize() + self.chars(string.digits, 3, 5) + self.pick("!?.*#"), "P@" + self.chars(alnum, 8)))
        q, m = self.pick("'\""), f"{OPEN}{strong}{CLOSE}"
        user, host, base = self.pick((w(), "admin", "root", "svc_" + w())), self.pick((w(), w() + ".example.net", "10.0.0.7", "db1")), w()
        login = self.pick(("connect", "db.connect", "pymysql.connect", "client.login", "login", "session.authenticate", "smtp.login", "ftp.login", "HTTPBasicAuth", "new Client", "imap.login", "api.signIn"))
        start = self.pick(("", f"{w()} = ", "return ", "await ", "    ", f"const {w()} = "))
        end = self.pick(("", ";", ")", "  # " + w()))
        other = self.pick(("create", "resize", "move", "copy", "print", "log.info", "assertEqual", "f", "set_range", "client.get"))
        return self.pick(
            (
                f"{start}{login}({q}{host}{q}, {q}{user}{q}, {q}{m}{q}){end}", f"{start}{login}({q}{user}{q}, {q}{m}{q}){end}", f"{start}{login}({q}{host}{q}, {q}{user}{q}, {q}{m}{q}, {q}{base}{q}){end}", f"{start}{login}({q}{host}{q}, 3306, {q}{user}{q}, {q}{m}{q}){end}",
                f"requests.get(url, auth=({q}{user}{q}, {q}{m}{q}))", f"{start}auth = ({q}{user}{q}, {q}{m}{q}){end}", f"api_keys = [{q}{m}{q}]", f"names = [{q}{user}{q}, {q}{base}{q}]", f"tokens = [{q}{base}{q}, {q}{user}{q}]", f"{start}{login}({q}{host}{q}, {q}{user}{q}, os.environ[{q}{w().upper()}{q}]){end}", f"{start}{login}({q}{host}{q}, {q}{user}{q}){end}", f"{start}{login}({q}{user}{q}, getpass()){end}",
                f"{start}{login}({q}{host}{q}, {q}{user}{q}, {q}${{PASS}}{q}){end}", f"{start}{other}({q}{user}{q}, {q}{self.chars(alnum, 9, 14)}{q}, {q}{base}{q}){end}", f"{start}{other}({q}{host}{q}, {r.randint(1, 999)}, {q}{w()}{q}){end}", f"{start}{login}({q}{host}{q}, {q}{self.digest()}{q}){end}" if r.random() < 0.3 else f"{start}{other}({q}{self.digest()}{q})",
            )
        )

    def sentence(self) -> str:
        """Ordinary technical prose with names, numbers and code spans."""
        w, r = self.word, self.rng
        name = f"{w()}-{w()}"
        return self.pick(
            (
                f"{name} keeps the {w()} {w()} below {r.randint(1, 999)} after a cold start.", f"Run {w()} against {name} to scale a {w()} {w()} with {r.randint(1, 99)} workers.", f"Set `{w()}_{w()}_limit` to {r.randint(1, 999)} before you drain the {w()}, otherwise {name} flushes it.",
                f"Look at `/etc/{w()}/{w()}.yaml`: its {w()} {w()} labels {r.randint(1, 99)} items per {w()}.", f"Logs from {name} show a {w()} {w()} that {w()} polled {r.randint(1, 999)} times.", f"It took {r.randint(1, 60)} minutes until {name} moved the {w()} secretless-store and {w()} returned {r.randint(1, 999)}.",
                f"The tokenizer {w()} belongs to {name}, not to {w()}-{w()}, so {w()} signs it.", f"Keep `token_window_{w()}` below {r.randint(1, 999)}; {name} rotates a {w()} key-store when {w()} raises it.",
            )
        )

    def sample(self) -> tuple[str, str]:
        """A line, at times with prose around it on the same line."""
        line, outer = self.line()
        chance = self.rng.random()
        if chance < 0.1:
            line, outer = self.noise(), ""
        elif chance < 0.12:
            m = f"{OPEN}{self.chars(string.ascii_letters + string.digits, 16, 40)}{CLOSE}"
            line, outer = self.pick((f"the value {m} leaked", f"Someone posted {m} in the channel.", f"It printed {m} twice.", f"{m} was found in the log", f"- {m}", f"# {m}", f'"{m}"')), ""
        if self.rng.random() < 0.22:
            line = " ".join([self.sentence() for _ in range(self.rng.randint(0, 2))] + [line.strip()] + [self.sentence() for _ in range(self.rng.randint(0, 2))])
        return line, outer

    def line(self) -> tuple[str, str]:
        r = self.rng
        kind = r.random()
        if kind < 0.30:
            name = self.pick(SECRET_NAMES)
            if r.random() < 0.08:
                text = self.secret()
                cut = r.randint(3, len(text) - 2)
                return f'{self.spell(name)} = "{OPEN}{text[:cut]}{CLOSE}" + "{OPEN}{text[cut:]}{CLOSE}"', ""
            return self.assign(name, self.secret(), True)
        if kind < 0.48:
            name = self.pick(SECRET_NAMES)
            return self.assign(name, self.no_secret(name), False)
        if kind < 0.58:
            return self.assign(self.pick(DIGEST_NAMES), self.digest(), False)
        if kind < 0.66:
            name = self.pick(PLAIN_NAMES)
            return self.assign(name, self.pick((self.plain(), str(r.randint(1, 999)), self.no_secret(name))), False)
        if kind < 0.76:
            scheme = self.pick(("postgres", "postgresql", "mysql", "redis", "amqp", "mongodb+srv", "https", "ftp", "http"))
            good = r.random() < 0.72
            secret = self.secret().replace("@", "%40").replace("/", "x").replace(" ", "").replace("#", "x")
            if not good:
                secret = self.pick(("${DB_PASSWORD}", "<password>", "********", "{{ vault_pw }}".replace(" ", ""), "$PASSWORD", "PASSWORD", "xxxxx", "password", "REPLACE_ME", "changeme"))
            mid = f"{OPEN}{secret}{CLOSE}" if good else secret
            url = f"{scheme}://{self.pick((self.word(), 'admin', ''))}:{mid}@{self.word()}.example.{self.pick(('net', 'org', 'com'))}:{r.randint(1000, 9999)}/{self.word()}"
            name = self.pick(URL_NAMES)
            return self.pick(
                ((f'{name} = "{url}"', ""), (f"  {name}: {url}", ""), (f"export {name.upper()}={url}", ""), (f"Export failed: could not open {url}", ""), (f'  "{name}": "{url}",', ""), (f"      value: '{url}'", name.upper()), (f"git clone {url}.git", ""), (f"see {url} for details", ""))
            )
        if kind < 0.86:
            s = self.secret()
            word = s if not any(c in s for c in "\"'` ,;") else self.chars(string.ascii_letters + string.digits, 12)
            m = f"{OPEN}{word}{CLOSE}"
            fake = self.pick(("$TOKEN", "${API_TOKEN}", "<token>", "REPLACE_ME", "********", "{{ token }}", "YOUR_TOKEN_HERE"))
            basic = base64.b64encode((self.word() + ":" + self.chars(string.ascii_letters, 10)).encode()).decode()
            return self.pick(
                (
                    (f'headers = {{"Authorization": "Bearer {m}"}}', ""), (f'curl -H "Authorization: Bearer {m}" https://{self.word()}.test/v1', ""), (f"Authorization: Bearer {m}", ""), (f"2024-03-11 DEBUG > Authorization: Bearer {m}", ""),
                    (f'headers = {{"X-Auth": "Basic {OPEN}{basic}{CLOSE}"}}', ""), (f"sshpass -p '{m}' ssh {self.word()}@{self.word()}.example.net", ""), (f"sshpass -p {m} ssh {self.word()}@{self.word()}.test uptime", ""),
                    (f"curl -sS -u {self.word()}:{m} https://{self.word()}.test/{self.word()}", ""), (f"machine {self.word()}.test login {self.word()} password {m}", ""), (f"echo 'machine {self.word()}.test login {self.word()} password {m}' >> ~/.netrc", ""),
                    (f"# temporary login {self.word()} / password {m}", ""), (f"login {self.word()} / password {m}", ""), (f"user {self.word()}, password {m}", ""), (f"My key is {m} if you want to try it.", ""), (f"The password is {m} for now.", ""), (f"log in as {self.word()} with password {m}", ""), (f"I sign in to {self.word()}.test as {self.word()} with the password {m} and it works.", ""), (f"# old password: {m}", ""), (f"The staging login is {self.word()} / {m} until Monday.", ""), (f"login for {self.word()}: {self.word()} / {m}", ""),
                    (f"mysql -h {self.word()}.test -u{self.word()} -p{m} {self.word()}", "") if not word.startswith("-") else (f"use token {m}", ""), (f"docker login {self.word()}.test -u {self.word()} -p {m}", ""),
                    (f"The login page is {self.word()} / {self.word()} of the site.", ""), (f"docker run -p 8080:80 {self.word()}", ""), (f"mkdir -p /srv/{self.word()}/{self.word()}", ""), (f"use token {m} until friday", ""),
                    (f'headers = {{"Authorization": "Bearer {fake}"}}', ""), (f'curl -H "Authorization: Bearer {fake}" https://{self.word()}.test', ""), (f"sshpass -p \"$PASS\" ssh {self.word()}@{self.word()}.test", ""), (f"curl -u {self.word()}:$PASS https://{self.word()}.test", ""),
                    (f"The password is {fake} there.", ""), (f"password {fake} is asked for", ""),
                )
            )
        if kind < 0.91:
            label = self.pick(("PRIVATE KEY", "RSA PRIVATE KEY", "EC PRIVATE KEY", "OPENSSH PRIVATE KEY", "ENCRYPTED PRIVATE KEY", "PGP PRIVATE KEY BLOCK", "DSA PRIVATE KEY"))
            body = f"{OPEN}-----BEGIN {label}-----{CLOSE}"
            inline = f"{OPEN}-----BEGIN {label}-----\\n{self.chars(string.ascii_letters, 40)}\\n-----END {label}-----\\n{CLOSE}"
            return self.pick(((body, ""), ("    " + body, "tls.key"), (f'PEM = """{body}', ""), (f'KEY = "{inline}"', ""), (f'  "signer": "{inline}",', "")))
        if kind < 0.95:
            label = self.pick(("PUBLIC KEY", "CERTIFICATE", "RSA PUBLIC KEY", "PGP PUBLIC KEY BLOCK", "CERTIFICATE REQUEST", "SSH2 PUBLIC KEY"))
            body = f"-----BEGIN {label}-----"
            return self.pick(((body, ""), ("    " + body, "ca.crt"), (f'CA = """{body}', ""), (f'KEY = "{body}\\n{self.chars(string.ascii_letters, 40)}\\n-----END {label}-----\\n"', "")))
        if kind < 0.965:
            return self.call(), ""
        if kind < 0.98:
            name = self.pick(SECRET_NAMES)
            n, u = name, name.upper()
            return self.pick(
                (
                    f"{n} = getpass.getpass()", f'{n} = os.environ["{u}"]', f'{n} = os.getenv("{u}")', f'{n} = vault.read("/kv/{self.word()}/{self.word()}")', f"{n}: str = Field(min_length={r.randint(1, 99)})", f'{u}="$(vault kv get -field={n} {self.word()})"',
                    f"{n} = var.{n}", f"{n} = data.{self.word()}.{self.word()}.{n}", f"{n} = settings.{n}", f"def set_{n}(self, {n}): ", f"if not {n}: raise ValueError", f'parser.add_argument("--{n}")', f"{n}: {{ type: string }}", f"{n}=None", f"return {n}", f"{n} = request.headers.get('X-Auth')",
                    f"{n}: SecretStr", f"{n} = secrets.token_hex({r.randint(8, 32)})", f"{n} = hashlib.sha256(data).hexdigest()", f'print("{n}: %s" % masked)', f"{n} = input('password: ')",
                )
            ), ""
        return self.pick(PROSE), ""


def labelled(marked: str, outer: str) -> tuple[list[list[str]], list[str]]:
    spans, plain, at = [], [], 0
    opened = 0
    for c in marked:
        if c == OPEN:
            opened = at
        elif c == CLOSE:
            spans.append((opened, at))
        else:
            plain.append(c)
            at += 1
    tokens = lex("".join(plain), outer)
    labels = []
    for i, t in enumerate(tokens):
        hit = next((s for s in spans if t.at < s[1] and t.end > s[0]), None)
        if hit is None:
            labels.append("O")
        else:
            labels.append("I" if labels and labels[-1] != "O" and t.at > hit[0] else "B")
    return features_of(tokens), labels


def build(count: int = 26_000, seed: int = 11) -> Crf:
    maker = Maker(seed)
    return train([labelled(*maker.sample()) for _ in range(count)], ("O", "B", "I"), epochs=8).constrain("I", ("B", "I"))


def accuracy(crf: Crf, count: int = 3000, seed: int = 99) -> float:
    """Share of invented lines, other than the training's, that are labelled without any error."""
    maker = Maker(seed)
    good = 0
    for _ in range(count):
        features, labels = labelled(*maker.sample())
        good += crf.decode(features) == labels
    return good / count


if __name__ == "__main__":
    model = build()
    MODEL.write_text(json.dumps(model.as_dict(), separators=(",", ":"), sort_keys=True) + "\n")
    print(len(model.state), "features; lines labelled without error:", round(accuracy(model), 4))
