"""Made-up labelled sentences that the detector of personal information is fitted to.

Sentences come from templates whose slots are filled at random: pieces of personal information of many layouts, near misses of each kind,
and words that are drawn from the public lexicon or made up of syllables. The templates were written for this purpose; a test makes
sure that no fixed part of them stands in the test tables.
"""

from __future__ import annotations

import random
import re

from millrace.llm import lexicon

KINDS = ("email", "phone", "id_number", "address", "name")
# Some given names of several languages; half of the names in the sentences have one, the others' are made up.
GIVEN = (
    "Aaron Abigail Adele Agnes Alberto Alejandro Alex Amina Andreas Angela Anita Anton Barbara Benjamin Bernard Brian Bridget Bruce Carla Catherine Cecilia Charles Christian Claire Claudia Daniela Deborah Dennis "
    "Dorothy Edgar Eleanor Elizabeth Emily Enrique Esther Eugene Fabian Farah Francesca Fritz Gabriel George Gloria Grace Gunnar Harold Hasan Heather Henry Hope Ibrahim Igor Isaac Jacob Jasmine Jeremy Joan Joseph "
    "Joyce Karen Keith Kevin Lara Leonard Lorenzo Louise Lydia Manuel Margaret Matthew Mei Miriam Monica Naomi Nathan Nora Oscar Paula Philip Rachel Ramon Rebecca Ricardo Rose Ruben Sabine Sandra Sean Simon Sofia "
    "Sonja Stella Takeshi Theresa Timothy Tobias Ursula Valentina Victor Vincent Wanda Wendy Will Yasmin Yolanda Zahra"
).split()
# Family names that are words as well.
PLAIN = "Baker Banks Bell Bishop Black Brooks Brown Carter Church Cook Day Fields Fisher Ford Fox Gray Green Hall Hill Hunter King Knight Lamb Law Long Marsh Mason Page Park Porter Price Reed Rice Rose Sharp Short Singer Stone Swift Taylor Waters West White Wise Wolf Wood Young".split()
_ROLES = "owner author reviewer contact maintainer editor manager approver assignee translator client driver tenant recipient sender engineer teacher applicant".split()
_DEEDS = "written checked signed approved fixed filed sent owned led merged planned drawn kept proposed tested built".split()
_ORGS = "Systems Labs Inc Ltd Group Institute Foundation Bank Software Partners Studio University".split()

#: Slots: {name} {email} {phone} {id} {address} are labelled; {w} is a common word, {W} the same with a capital, {M} a made-up word with a capital, {m} in lower case,
#: {G} a given name, {P} a proper noun, {d} a number, {role} {deed} {org} come from the lists above.
_PEOPLE = """{name} {deed} it
{deed} by {name}
{w} {deed} by {name} in {y}
Please ping {name} about the {w}
I met {name} near {M}
{role}: {name}
{role} = {name}
"{role}": "{name}"
'{role}': '{name}'
# {role}: {name}
// {role} {name}
{role} - {name}
| {role} | {name} |
| {name} | {w} |
| {name} | {email} | {phone} |
{d};{name};{w}
{d};{name};{email};{phone}
{name},{email},{phone}
<{role}>{name}</{role}>
<li>{name}</li><li>{email}</li>
{name} <{email}>
{role} {name} <{email}>
{deed}-by: {name}
{Deed}-by: {name} <{email}>
{Deed} by {title} {name}
{title} {name} {said} so
{title} {name} will {w}
{name} {said} that {w} {w}
{Said} {name}: {w}
{Said} {name}, {w}
{Said} {name}
{name}, who {deed} the {w}, {said} no
{name} and {name} {deed} it
{name}, {name} and {name} came
as {name} once {said},
like {name} {said}: {w}
Hello {name}, how is the {w}?
Dear {title} {name},
Kind regards,\n{name}
Cheers\n{name}\n{phone}
Best, {name}
I am {name} and I {w} here
This is {name} from {M}
we hired {name} in {y}
{name}'s {w} is {w}
a call from {name}, {w} {d}
on behalf of {name}
{role}_name={name}; {w}
full {w} name: {name}
surname, first: {name}
the {w} of {name} is {w}
{w} for {name} / {id}
({name}) {w}
[{name}] {w} {w}
{name} ({phone})
{name} ({email})
# {name} ({phone})
{name} {phone}
{ROLE} {name} {phone}
{role}: {name}, {phone}
{name}, {idl} {id}
{name}; {idl} {id}
{idl} {id} - {name}
{name} at {address}
{name}, {address}
give it to {name}
{w} to {name}, never {w}
send {name} the {w}
{w}, with {name} and others
{w} with {name}.
then {name} {said}: {w}
von {name} {w}
an {title} {name} ({w})
por {name}, {w}
par {name} ({w})
{role} {name}, {w}
* {name}: {w}
- {name} {deed} the {w}
@{role} {name}
credit: {name}
{role}：{name}、{phone}
{role}：{name}。
{cjk}：{name}，{phone}
{cjk}：{name}。
{M}: {name}
{M}: {name}. {W} {w}
{cyr}: {cyrname}
{cyr} {cyrname}, {phone}
{cyrname} ({email})
his name is {name} or {name}
a name: {name}
{deed}-by: {name} {W} the {w}
负责人：{han}，{phone}
担当者：{han}さん
이름: {hangul}, {phone}""".split("\n")
_CONTACTS = """{w} {email} {w}
mail: {email}
reply_to = {email}
"{w}": "{email}"
{w}_mail: {email}
// {w} {email} {w}
<{email}>
({email})
[{w}]({email})
<a href='mailto:{email}'>
| {w} | {email} | {w} |
| {phone} | {w} |
please send it to {email} or {email}
to={email}; from={email}
{w};{email};{phone};{w}
{w},{d},{email}
<li>{email}</li><li>{phone}</li>
邮件：{email}。
メール {email}
{w} at night: {phone}
phone: {phone}
Phone {phone} ({w})
tel {phone}
Tel.: {phone}
fax: {phone}, {w}
"phone":"{phone}"
mobile={phone}
{ROLE}_PHONE="{phone}"
ring {phone} or {phone}
sms to {phone}
dial {phone} if it {w}
our number is {phone}
{w} ({phone}) is {w}
{phone}
+ {phone}
tel:{phone}
电话：{phone}
電話 {phone}
Telefon {phone}
tél : {phone}
{w} - {phone}
{idl}: {id}
{idl} {id}
{idl}={id}
"{idk}": "{id}"
{idk}={id}; {w}
{w}, {idl} {id}
({idl} {id})
{d};{name};{id}
{name};{email};{id}
{phone};{id}
{email};{phone};{id}
{w} with {idl} {id} on it
- {idl}: {id}
| {idl} | {id} |
his {idl} is {id}
{idl} {id} - {w}
{w} - {idl} {id} - {w}
{w} / {id} that
address: {address}
"address": "{address}"
I live at {address}
ship to: {address}
{address}
{w}: {address}
we moved to {address} in {y}
{w};{address};{w}
| {address} | {w} |
come to {address}, please
{w} is at {address} and {w}
Adresse: {address}
Dirección: {address}
indirizzo: {address}
{M} lives in {address}""".split("\n")
_NEAR = """{w} git@{m}.com:{m}/{m}.git
git remote add {m} git@{m}.org:{m}/{m}
npm i @{m}/{m}@{d}.{d}.{d}
{m}@{d}.{d}.{d}
@{m}/{m}@{d}.{d}
scp {m} root@{m}.{m}.com:/srv/{m}
ssh ubuntu@{m}.{m}.net:{d}
rsync -a git@{m}.org:{m}/x .
docker pull {m}@sha256:{x}{x}
@{m}.{m} does it
{w} <@{m}>
order {D3}-{D7}-{D7}
ISBN 97{D1}-{d}-{D4}-{D4}-{D1}
ISSN {D4}-{D4}
{D10} is the epoch
epoch {D10}, {w}
ts={D10}.{D3}
{w} {y}-0{D1}-1{D1}-{D4}
{y}-1{D1} 1{D1}:{D2}:{D2}
192.168.{D2}.{D3}:{D5}
10.{D2}.{D3}.{D2}
{D3}.{D3} {D3}.{D3} ms
{D3}.{D6} {D3}.{D6}
{w} ({D3} {D3} {D3} rows)
{D8} bytes
{D9} bytes read
{D9} rows
{w} {D9} times
size {D11}
{D2} {D3} {D3} {D3} tokens
v{D1}.{D3}.{D4}
version {D3}.{D3}.{D3}
{w} {D3}-{D2}-{D4} in the {w} table
ticket {U2}{D6}
bug {U2}-{D3}-{D4}
{U3}-{D4}-{D4}
part no {U1}{D7}
sku {U2}{D7}
serial {U1}{D8}
rev {D9}
commit {D8}{u}
batch {D6}-{D4}
invoice {D6}-{D4}
job {D11}
trace {D3} {D3} {D3}
{D4} {D4} {D4} {D4}
0x{D8}
{d}-{d} of {D9}
$ {D3} {D3} {D3}
{x}-{D4}-{D4}-{x}
port {D5}-{D5}
{D2}/{D2}/{y} {D2}:{D2}
the {M} Street {w}
{d} {M} Road {w}s
{w} {d} Main {W} Way
{d} {W} Drive letters
step {d} {W} Close the {w}
Via {w} {d}
Calle {d}
Place {d}
{d} place {W}""".split("\n")
_THINGS = """the {G} {W} {w}
the {G} {W} or a {M} {W}
a {M} {W} {w}
our {M} {W} {w}s
The {W} {W} are {w}
The {M} {org} {w} {w}
{M} {org} {w} the {w}
{M} {org}, {M} {org}
{w}. {M} {org} sells it
{P} {org} {w}
{G} {org} {w}s a {w}
{w} by {M} {org}
from {P} {org}
{W} {W}
# {W} {W}
## {W} {M}
{W} {W}: {w}
{W} {W} {W}
{W} the {M} {W}
{W} {M} {w}
{W} {M}, {M}
{w}. {W} {M} {w}
{w}. {W} {P} {w}
In {P}, {M} {w}s
{P}, {P}
near {P}, {P}
{P} {W} {d}
{w} in {P} {W}
on {P} {W}
with {P} {W}.
{w} to {P} {W}, {w}
Use {P} {W} {w}
See {W} {d} of the {M} {W} {W}
see the {W} {W} {W}
{w} to {W} {W} {w}
with {W} {W} {w}
and {W} {W}, {w}
for {G} {W} {w}
of {W} {P}
"{w}": "{W} {W}"
{w}: {W} {W}
{w} = {M} {W}
| {W} {W} | {w} |
| {M} {W} | {P} |
{role}: {W} {W}
{W}, {W} and {W}
{W}, {M} {w}
- {W} {W} {w}
{d}. {W} {W}
{U1}. {W} the {w}
{w} {U1}. {W} it
{w} {U1}. {W} {W}
{M} {M} {w} {w}s
{M} {M} 
{w} {m} {m}
{w}: {m} {w}
with {m} and {w}
by {w} {m},
{cue} {w} {odd} {w}
For {odd} {w}s, {w} the {w}
From {w} {odd}s, {w} it
As {odd} {w}s {w}
{w} to {odd} {w}s and {w}
{w}. {Der} {W}s {w}
{Der} {M}s {w} {w}
{Odd} {W}s {w} {w}
{Neue} {M}s {gehen} {w}
- {Neue} {M} {gehen} {m} {w}
{w}. {Neue} {W}s {gehen} {m}
# {Neue} {M} {gehen}
{m} {m}. {Neue} {M}s {gehen} {m}
{Odd} {M}s {w} {w}
- {Odd} {W} {w}
{w}: {Odd} {M} {w}
{Cyr} {cyr} {cyr}
{cue} {odd} {w} {w}
{w} {cue} {w} {odd}
{w} {cue} {odd} {Der}
{w} {cue} {odd} {w}.
{w}: {w} {odd}, {w}
{w}: {odd} {w}
"{odd} {w}"
"{w} {odd}"
{w}={odd} {w}
({w} {odd})
> {odd} {w} |
for {m} {w} ({w})
to {m} {m} {w}
and {m} {w}
{w} by {w} {m}
as {m} {w} it
({m} {w})
= {m} {w}
"{m} {w}"
"{w} {m}"
"{w} {w} {m}"
; {w} {m} {m} >
{Der} {W} {w}
{Der} {M} {w} {d}
{Der} {W}, {Der} {W}
{W} {G} {w}
{G}, the {w}, {w}
{G} {w}s {W}
{W} {G}'s {w}
负责人：{w}
设置：{hanw}，
名称：{hanw}。""".split("\n")

_SLOT = re.compile(r"\{(\w+)\}")


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        words = lexicon.read()
        ranked = sorted((k for k in words.low if k.isascii() and len(k) > 2), key=lambda k: (words.low[k], k))
        self.common = ranked[40:9000]
        self.proper = sorted(k for k, v in words.up.items() if k not in words.low and k.isascii() and len(k) > 3)

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def letters(self, n: int) -> str:
        return "".join(self.r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ") for _ in range(n))

    def made(self) -> str:
        r = self.r
        s = "".join(r.choice(["b", "br", "c", "ch", "d", "dr", "f", "g", "gr", "h", "j", "k", "kr", "l", "m", "n", "p", "qu", "r", "s", "sh", "st", "t", "th", "tr", "v", "w", "x", "y", "z", ""]) + r.choice("aeiou") + r.choice(["", "", "l", "m", "n", "nd", "r", "rt", "s", "sk", "t", "x", "z"]) for _ in range(r.choice([1, 2, 2, 2, 3])))
        s = s if len(s) > 2 else s + r.choice("lnrst") + r.choice("aeiou")
        if r.random() < 0.12:
            k = r.choice([k for k, c in enumerate(s) if c in "aeiou"])
            s = s[:k] + r.choice({"a": "áäâå", "e": "éèë", "i": "íï", "o": "óöø", "u": "úü"}[s[k]]) + s[k + 1 :]
        return s

    def word(self) -> str:
        return self.r.choice(self.common[:1500] if self.r.random() < 0.5 else self.common)

    def odd(self) -> str:
        """A word that the lexicon doesn't hold, as derived or technical ones."""
        return self.word() + self.r.choice(["izer", "able", "ify", "ish", "wise", "less", "let", "base", "set", "er", "ate"]) if self.r.random() < 0.6 else self.made().encode("ascii", "ignore").decode() or "ab"

    def cyrillic(self) -> str:
        return "".join(self.r.choice("бвгдзклмнпрст") + self.r.choice("аеиоу") for _ in range(self.r.choice([2, 3]))).capitalize() + self.r.choice(["в", "н", "й", "а"])

    def given(self) -> str:
        x = self.r.random()
        return self.r.choice(GIVEN) if x < 0.45 else self.r.choice(self.proper).capitalize() if x < 0.55 else self.made().capitalize()

    def family(self) -> str:
        x = self.r.random()
        if x < 0.12:
            return self.r.choice(PLAIN)
        if x < 0.24:
            return self.r.choice(self.proper).capitalize()
        s = self.made().capitalize()
        if x > 0.94:
            s += "-" + self.made().capitalize()
        elif x > 0.9:
            s = self.r.choice(["O'", "D’", "Mc", "Mac"]) + s
        elif x > 0.86:
            s = self.r.choice(["von", "van", "de", "van der", "del", "da", "di", "el"]) + " " + s
        return s

    def name(self) -> str:
        r, x = self.r, self.r.random()
        if x < 0.06:
            return f"{self.cyrillic()} {self.cyrillic()}"
        g, f = self.given(), self.family()
        s = f"{g} {f}" if x < 0.55 else f"{g} {self.letters(1)}. {f}" if x < 0.64 else f"{self.letters(1)}. {f}" if x < 0.74 else f"{f}, {g}" if x < 0.83 and " " not in f else f"{g} {self.given()} {f}" if x < 0.86 else f"{f} {g}" if x < 0.89 and " " not in f else f"{g} {f}"
        y = r.random()
        return s.upper() if y < 0.05 else s.lower() if 0.05 < y < 0.12 and "," not in s else s

    def email(self) -> str:
        r, m = self.r, lambda: self.made().encode("ascii", "ignore").decode() or "ab"
        local = r.choice([m, lambda: f"{m()}.{m()}", lambda: f"{m()}_{m()}", lambda: f"{m()}+{m()}", lambda: f"{m()}{self.digits(2)}", lambda: f"{m()}-{m()}", lambda: f"{m()[0]}{m()}", lambda: self.word()])()
        parts = r.choice([[m(), "example"], ["example", r.choice(["com", "org", "net"])], ["mail", m(), "test"], [m(), "invalid"], [m(), "example", "net"], [m(), r.choice(["com", "de", "io", "fr", "co"])], [m(), "co", "uk"]])
        at, dot = r.choice([("@", ".")] * 5 + [(" [at] ", " [dot] "), (" AT ", " DOT "), ("(at)", "."), (" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("＠", "."), ("&#64;", "."), ("%40", ".")])
        s = local + at + dot.join(parts)
        return s.upper() if r.random() < 0.05 and at == "@" else s

    def phone(self) -> str:
        d = self.digits
        return self.r.choice([lambda: f"+1 {d(3)} {d(3)} {d(4)}", lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"+{d(11)}", lambda: f"+49 {d(2)} {d(5)} {d(3)}", lambda: f"0{d(2)}/{d(5)}-{d(3)}", lambda: f"+33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: ".".join(["0" + d(1), *(d(2) for _ in range(4))]), lambda: " ".join(["0" + d(1), *(d(2) for _ in range(4))]), lambda: f"+46 (0){d(1)} {d(3)} {d(3)} {d(2)}", lambda: f"00{d(2)} {d(1)} {d(4)} {d(4)}", lambda: f"0{d(2)} {d(4)} {d(4)}", lambda: f"+44 {d(2)} {d(4)} {d(4)}", lambda: f"0{d(4)} {d(6)}", lambda: f"+{d(2)} {d(3)} {d(3)} {d(3)}", lambda: f"+{d(2)}-{d(2)}-{d(4)}-{d(4)}", lambda: f"0{d(3)}-{d(7)}", lambda: f"+{d(2)} {d(5)} {d(5)}"])()

    _IDS = [("SSN", "ssn", "3-2-4"), ("social security number", "social_security", "9"), ("SSN", "ssn", "3 2 4"), ("CPF", "cpf", "c"), ("DNI", "dni", "8-L"), ("DNI", "dni", "8L"), ("NIE", "nie", "X7L"), ("Passport", "passport", "L8"), ("passport no", "passport_no", "LL7"), ("Reisepass", "reisepass", "L8"), ("Steuer-ID", "tax_id", "2 3 3 3"), ("tax number", "tax_no", "11"), ("personnummer", "personnummer", "6-4"), ("national insurance", "nino", "n"), ("NINO", "nino", "LL6A"), ("national id", "national_id", "9"), ("PESEL", "pesel", "11"), ("BSN", "bsn", "9"), ("SIN", "sin", "3 3 3"), ("Aadhaar", "aadhaar", "4 4 4"), ("PAN", "pan", "LLLLL4L"), ("identity card", "id_card", "L8"), ("codice fiscale", "fiscal_code", "LLLLLL2L2L3L")]

    def number(self, layout: str) -> str:
        d, up = self.digits, self.letters
        if layout == "c":
            return f"{d(3)}.{d(3)}.{d(3)}-{d(2)}"
        if layout == "n":
            return f"{up(2)} {d(2)} {d(2)} {d(2)} {self.r.choice('ABCD')}"
        if layout == "X7L":
            return self.r.choice("XYZ") + self.r.choice(["", "-"]) + d(7) + self.r.choice(["", "-"]) + up(1)
        if layout == "LL6A":
            return up(2) + d(6) + self.r.choice("ABCD")
        return "".join(d(int(x)) if x.isdigit() else up(1) if x == "L" else x for x in re.findall(r"\d+|.", layout))

    def address(self) -> str:
        r, n, st, city, d, up = self.r, str(self.r.randint(1, 250)), self.made().capitalize(), self.made().capitalize(), self.digits, self.letters
        return r.choice([lambda: f"{n} {st} {r.choice(['St', 'Street', 'Avenue', 'Road', 'Lane', 'Close', 'Blvd.', 'Drive', 'Way'])}, {r.choice(['', 'Apt 4, ', 'Suite 12, '])}{city}, {up(2)} {d(5)}", lambda: f"{n} {st} {r.choice(['Street', 'Road', 'Lane', 'Terrace'])}, {city}, {up(2)}{d(1)} {d(1)}{up(2)}", lambda: f"Flat {r.randint(1, 30)}, {n} {st} Court, {city} {up(2)}{d(1)} {d(1)}{up(2)}", lambda: f"{n} {st} {r.choice(['Street', 'Ave', 'Road'])}", lambda: f"{n}{r.choice(['', ' bis', ','])} {r.choice(['rue', 'avenue', 'place'])} de {st}, {d(5)} {city}", lambda: f"{n} rue {st}, {d(5)} {city}", lambda: f"Calle {st} {n}, {r.randint(1, 6)}º B, {d(5)} {city}", lambda: f"Calle {st}, {n}, {d(5)} {city}", lambda: f"Rua {st}, {n}, {d(5)}-{d(3)} {city}", lambda: f"Via {st} {n}, {d(5)} {city}", lambda: f"{st}{r.choice(['straße', 'weg', 'gasse', 'str.', 'platz'])} {n}, {d(5)} {city}", lambda: f"{st}weg {n}{r.choice('abc')}, D-{d(5)} {city}", lambda: f"{st}straat {n}, {d(4)} {city}", lambda: f"{st}gatan {n}"])()

    def fill(self, template: str) -> tuple[str, list[tuple[int, int, int]]]:
        r, out, spans, at, one = self.r, "", [], 0, r_id(self)
        for m in _SLOT.finditer(template):
            out += template[at : m.start()]
            at, k = m.end(), m[1]
            if k in ("name", "cyrname", "email", "phone", "address", "id", "han", "hangul"):
                v = self.number(one[2]) if k == "id" else "".join(r.choice("王李张刘陈山田中木佐藤林金朴崔") for _ in range(r.choice([2, 3, 4]))) if k == "han" else "".join(r.choice("김이박최정강조민서지현우준영수") for _ in range(3)) if k == "hangul" else f"{self.cyrillic()} {self.cyrillic()}" if k == "cyrname" else getattr(self, k)()
                spans.append((4 if k in ("han", "hangul", "cyrname") else 2 if k == "id" else KINDS.index(k), len(out), len(out) + len(v)))
            else:
                v = self.plain(k, one)
            out += v
        return out + template[at:], spans

    def plain(self, k: str, one: tuple[str, str, str]) -> str:
        r = self.r
        if k[0] in "DU" and k[1:].isdigit():
            return (self.digits if k[0] == "D" else self.letters)(int(k[1:]))
        return {
            "w": self.word, "W": lambda: self.word().capitalize(), "M": lambda: self.made().capitalize(), "m": lambda: self.made().encode("ascii", "ignore").decode() or "ab", "G": lambda: r.choice(GIVEN), "P": lambda: r.choice(self.proper).capitalize(), "d": lambda: self.digits(r.choice([1, 2, 3])).lstrip("0") or "7",
            "y": lambda: f"20{self.digits(2)}", "x": lambda: "".join(r.choice("0123456789abcdef") for _ in range(8)), "u": lambda: r.choice("abcdef"), "role": lambda: r.choice(_ROLES), "ROLE": lambda: r.choice(_ROLES).upper(), "deed": lambda: r.choice(_DEEDS), "Deed": lambda: r.choice(_DEEDS).capitalize(), "org": lambda: r.choice(_ORGS),
            "title": lambda: r.choice(["Mr", "Mrs", "Ms", "Dr.", "Prof.", "Herr", "Frau", "Sr.", "Mme"]), "said": lambda: r.choice(["said", "asked", "wrote", "put", "told", "thinks", "noted"]), "Said": lambda: r.choice(["Says", "Asked", "Wrote", "Signed", "Added", "Owned", "Filed", "Told"]), "cjk": lambda: r.choice(["联系人", "担当", "作者", "负责人", "氏名", "客户"]), "cue": lambda: r.choice("by from to with for and as an or the in of on".split()), "odd": self.odd, "Odd": lambda: self.odd().capitalize(), "cyr": lambda: self.cyrillic().lower(), "Cyr": self.cyrillic, "idl": lambda: one[0], "idk": lambda: one[1],
            "Der": lambda: r.choice("Der Die Das Den Ein Eine Alle Le La Les Un Une El Los Las Una O A Il".split()), "Neue": lambda: r.choice("Alle Neue Alte Weitere Andere Einige Viele Manche Fehlende Offene Letzte Erste Ganze Kleine Große Gute Beide Solche Rote Kurze Freie Leere Ältere Jüngere Öffentliche".split()), "gehen": lambda: self.r.choice("gehen stehen fallen werden müssen können folgen enden warten laufen gelten liegen kommen sollen dürfen".split()), "hanw": lambda: "".join(r.choice("文件数据系统版本配置日志缓存模块流程检查") for _ in range(r.choice([2, 3, 4]))),
        }[k]()


def r_id(m: Maker) -> tuple[str, str, str]:
    return m.r.choice(m._IDS)


def labelled(n: int, seed: int = 5) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """``n`` sentences with the spans ``(kind, start, end)`` of their personal information; about half hold near misses alone."""
    m = Maker(seed)
    out = []
    for i in range(n):
        parts = [m.fill(m.r.choice((_PEOPLE, _CONTACTS, _THINGS, _NEAR)[(0, 2, 1, 2, 0, 3)[i % 6]]))]
        for _ in range(m.r.choice([0, 0, 1, 2])):
            parts.insert(m.r.choice([0, len(parts)]), (" ".join(m.word() for _ in range(m.r.randint(2, 9))).capitalize() + m.r.choice([".", ":", "", ","]), []))
        text, spans = "", []
        for t, s in parts:
            if text:
                text += m.r.choice([" ", " ", "\n", "\n\n", "\n- ", " - "])
            spans += [(k, a + len(text), b + len(text)) for k, a, b in s]
            text += t
        out.append((text + m.r.choice(["", "\n", ".", ""]), spans))
    return out


def fixed_parts() -> list[str]:
    """What stands between the slots of the templates."""
    return [p for t in (*_PEOPLE, *_CONTACTS, *_NEAR, *_THINGS) for p in _SLOT.split(t)[::2]]
