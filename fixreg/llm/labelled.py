"""Small labelled tables for the two taggers, drawn by rule from a fixed seed.

A row is a text and its labelled spans.  Templates hold the marked kinds in
braces; everything else in them is outside.
"""

from __future__ import annotations

import random
import re

from .crf import CUES

# Lines with a secret.
SECRET_LINES = [
    "the password is {secret}", "password for staging: {secret} (rotate)", "login admin pwd {secret}", "DB_PASSWORD={secret}", "export AWS_SECRET={secret}",
    "Authorization: Bearer {secret}", "auth {secret} expires soon", "client credential {secret}", "secret_key = '{secret}'", "private_key: {secret}",
    "use token {secret} to log in", "apikey {secret}", "{word} {word} bearer {secret} {word}", "passphrase \"{secret}\"", "credentials: {name} {secret}",
    "{word} {issued} {word}", "{issued}", "{Word} {word} {word} {issued}.", "- {issued}", "curl -H 'Authorization: Bearer {secret}' {word}", "key: {issued}", "{word} ({issued}) {word}",
    "her login is {word} / {secret}", "{Word} pwd is {secret} {word}", "use credential {secret}, {word} {word}", "auth={issued}&{word}", "\"{issued}\",",
]
# Lines with personal data.
PERSON_LINES = [
    "My name is {name}.", "Contact: {name}", "Dear Mr {name},", "Signed, Dr. {name}", "Mrs {name} {word} {word}", "by {name}", "Herr {name} {word}", "Name: {name}",
    "Regards, {name}", "señora {name} {word}", "SSN {id}", "passport {id} {word}", "IBAN: {id}", "account {id}", "call {id} {word}", "tel. {id}", "phone {id}", "fax: {id}",
    "{word} {word} {given} {word}", "{given} {word} {word} {word}.", "{Word} {word} {given}, {word} {word}.", "{word} {word} {given}.", "{word} {given} and {given} {word}", "{given}: {word} {word}",
    "Dear Mrs. {last},", "Dear Mr. {last}, {word}", "Ms. {last} {word} {word}", "{word} Prof. {last} {word}", "Dr. {last} {word} {word}.",
    "passport no. {id}", "{word} passport number {id}, {word}", "IBAN {iban}", "account no. {iban}", "{word} iban {iban}.", "BSN {nine}", "ID number {nine}", "license no. {id} {word}", "id nr. {nine}",
]
# Lines without either.
CLEAN_LINES = [
    "{word} {word} {word} {word} {word}.", "{Word} {word} {word}, {word} {word}.", "{word}. {Word} {word} {word}. {Word} {word}.", "{Word}. {Word}. {Word} {word}",
    "{WORD} {WORD} {WORD}!!", "| {word} | {word} | {Word} |", "{word}*** {word}### {word}&&& {word}%%%", "{word} {digits} {word}", "{word} {year}-{two}-{two} {word}",
    "version {digit}.{digit}.{digit} {word}", "commit {hex}", "sha256: {hex}", "uuid {hex}", "checksum = {hex}", "build {digits} {word}", "{word} {hex} {word}",
    "http://www.{word}.com/{word}/{word}", "{word}@{word}.com {word}", "+1 ({three}) 555-{digits} {word}", "{word} {card} {word}", "{three}.{two}.{two}.{three} {word}",
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "the password is {word}", "the token is {word} {word}",
    "a secret {word} {word}", "by {word} {word}", "account of {word}", "call {word} {word}", "token: {word}", "id {word}", "{word}: {word}", "{word} = {digits}", "{Word}{Word}{Word} {word}",
    "{word} {AKIA} {word}", "{word} {word}.{two}@mail{digit}.example.com {word}", "name of {word} {word}", "contact {word} {word}", "the author {word}", "dear {word}", "{Word} by {word}. {Word} {word}",
    "{word} {word}. {Word}. {Word}", "{word} {word}. {Word} {word}. {Word}. {Word} {word}", "{Word} {Word} {Word} {Word} {Word}", "{word} {Word} {Word}", "{word}. {Word}. {Word}. {Word}.",
    "{Word}, {word} {word}. {Word}", "{WORD} {WORD}, {WORD}", "{word} {word}.{two}@mail{digit}.example.com {word}. {Word} {word}", "{Word} {word}. {Word} {Word} {word} {word}",
    "{word}. {only} {word} {word}.", "{only} {word} {word}", "{WORD} {ONLY}!! {WORD}", "{WORD}!! {ONLY}!! {WORD}!!", "{word} by {only}", "{word} {only} {word}", "{word}. {only}. {Word} {word}",
    "{word} {word} no. {Word} {word}.", "{word}. No. {Word} {word} {word}", "{Word} no. {Word}", "| {only} | {Word} |", "{word} no. {word} {word}",
    "{Word} {Word}.", "{Word} {Word}", "| {Word}, | {Word} |", "{Word} {Word}.\n{Word} {Word}.", "{Word} {Word} {word}.", "{word} {word} {Word} {Word}.",
]
# Syllables of invented words.
SYLLABLES = "an at be ble ch ci ción co da de des do eau ed en ent er es ge gen ha he ie ich ier ing ion keit la le lich lo ly ment mi na nd on ou pa que re sch st th the ti tion tre um ung vi wh ü ß ñ é è ä ö ó í".split()
# Beginnings of issued keys.
ISSUED = "ghp_ gho_ github_pat_ glpat- sk_live_ sk-proj- xoxb- xoxp- npm_ pypi- hf_ SG. shpat_ dop_v1_ AIza ya29.".split()
FIRST = "Anna Ben Carla David Elena Frank Greta Hugo Ines Jakob Karin Louis Maria Nils Olga Paul Rosa Stefan Tom Vera".split()
LAST = "Adams Baker Costa Dietrich Evans Fischer Garcia Hansen Ivanov Jensen Keller Lopez Moreau Novak Olsen Petit Quinn Rossi Schmidt Turner".split()


GIVEN = CUES[5].split()
# The kind that a marked part is labelled as.
MARKED = {"secret": "secret", "issued": "secret", "name": "name", "given": "name", "last": "name", "id": "id", "iban": "id", "nine": "id"}


def _fill(line: str, r: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    def word() -> str:
        return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 5)))

    def some(chars: str, n: int) -> str:
        return "".join(r.choice(chars) for _ in range(n))

    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    both = letters + letters.upper() + digits

    def mixed() -> str:
        while True:
            out = r.choice([some(both, r.randint(12, 40)), some(both + "+/", r.randint(20, 44)), some(letters + digits, r.randint(16, 36)), some(both + "-_", r.randint(14, 32))])
            if sum(c in digits for c in out) >= 3:
                return out

    make = {
        "word": word, "Word": lambda: word().capitalize(), "WORD": lambda: word().upper(), "digits": lambda: some(digits, r.randint(1, 6)), "digit": lambda: some(digits, 1),
        "two": lambda: some(digits, 2), "three": lambda: some(digits, 3), "year": lambda: str(r.randint(1950, 2030)), "hex": lambda: some("0123456789abcdef", r.choice([8, 12, 32, 40, 64])),
        "card": lambda: "4" + some(digits, 15), "AKIA": lambda: "AKIA" + some(letters.upper() + digits, 16), "secret": mixed,
        "name": lambda: f"{r.choice(FIRST)} {r.choice(LAST)}", "only": lambda: r.choice(GIVEN).capitalize(), "ONLY": lambda: r.choice(GIVEN).upper(),
        "last": lambda: r.choice([r.choice(LAST), word().capitalize()]),
        "given": lambda: f"{r.choice(GIVEN).capitalize()} {r.choice([r.choice(LAST), word().capitalize(), r.choice('ABCDEFGHJKLM') + '. ' + r.choice(LAST)])}",
        "issued": lambda: r.choice([r.choice(ISSUED) + some(both, r.randint(20, 40)), "eyJ" + ".".join(some(both + "-_", r.randint(18, 40)) for _ in range(3))]),
        "iban": lambda: r.choice([(c := some(letters.upper(), 2) + some(digits, 2)) + " " + " ".join(some(digits, 4) for _ in range(r.randint(3, 5))) + r.choice(["", " " + some(digits, r.randint(1, 3))]), c + some(letters.upper(), 4) + some(digits, 10)]),
        "nine": lambda: some(digits, 9),
        "id": lambda: r.choice([f"{some(digits, 3)}-{some(digits, 2)}-{some(digits, 4)}", f"{some(digits, 3)}-{some(digits, 3)}-{some(digits, 4)}", some(letters.upper(), 2) + some(digits, r.randint(7, 20)), f"{some(digits, 4)}/{some(digits, 6)}"]),
    }
    out, spans, at = "", [], 0
    for m in re.finditer(r"\{(\w+)\}", line):
        out += line[at:m.start()]
        said = make[m[1]]()
        if m[1] in MARKED:
            spans.append((len(out), len(out) + len(said), MARKED[m[1]]))
        out, at = out + said, m.end()
    return out + line[at:], spans


def labelled(lines: list[str], kinds: set[str], each: int = 16, seed: int = 7) -> tuple[list[str], list[list[tuple[int, int, str]]]]:
    """Each template ``each`` times (clean ones too), alone or between clean lines, with the spans of ``kinds``."""
    r = random.Random(seed)
    texts, labels = [], []
    for line in [*lines, *CLEAN_LINES]:
        for _ in range(each):
            said, spans = _fill(line, r)
            head = "".join(_fill(r.choice(CLEAN_LINES), r)[0] + "\n" for _ in range(r.choice([0, 0, 1, 3])))
            texts.append(head + said)
            labels.append([(a + len(head), b + len(head), k) for a, b, k in spans if k in kinds])
    return texts, labels
