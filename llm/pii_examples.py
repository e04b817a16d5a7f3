"""A small labelled table of sentences with personal data, made from templates by a seeded rule."""

from __future__ import annotations

import random
import re

KINDS = ("email", "ip", "card", "phone")
# Sentences of the table; {kind} marks an entity, <x> a filler.
TEMPLATES = (
    "write to {email} before <word> or call {phone} at night",
    "contact <Word> at {email} for the <word>",
    "<word> mail: {email} <word> <word>.",
    "my address is {email}, <word> it with care",
    "e-mail {email} or tel. {phone}",
    "phone {phone} <word> <word>",
    "call us on {phone}, <word> the <word> of <word>",
    "tel: {phone} fax: {phone}",
    "mobile {phone}. <Word> <word> <word>",
    "ring {phone} and ask for <Word>",
    "<word> <word> {phone} <word>",
    "<word> <word> {email} <word>",
    "<word> <word> {ip} <word>",
    "<word> {card} <word> <word>",
    "<word> <word> <word> {card} <word> <word>",
    "<Word> <word> <word> <word> {card}.",
    "{card}, <word> <word> <word>",
    "{email} <word> <word> <word> <word>",
    "<Word> <word> <word> <word> {email}.",
    "{phone} <word> <word> <word> <word>",
    "<Word> <word> <word> <word> {phone}.",
    "the host {ip} did not answer the <word>",
    "login from {ip} <word> <word>",
    "server at {ip}, <word> on <word>",
    "card number {card} <word> <word>",
    "pay with card {card}, <word> <word>",
    "visa {card} expires in <year>",
    "in <year> the <word> had <number> of them",
    "<word> version <version> of the <word> is out",
    "order <number> <word> <word> on page <small>",
    "<Word> <word>, <word> and <word> of <word>.",
    "<word> at the <word> and dot the <word>",
    "we met at <word> in <year> with <small> <word>",
    "<word> | <word> | <word> | <small>",
    "<word> at <word> <word>, the dot <word> at <word>",
    "<symbols> <word> <symbols> <number> <word>",
    "token = <hex> <word> <word>",
    "<word> <hex> <word> <number>",
    "<word>, <small>.<small> of <word> (<year>)",
    "the call was at <small> and the card was <word>",
    "the mail and the phone of <Word> <word>",
    "<word> <number>-<small> <word> <year>-<year> <word>",
    "<symbols> <symbols> the.### <symbols> <symbols> <symbols>",
    "<word> <symbols> at <symbols> <symbols> of.%%% <symbols>",
    "The.&&& <symbols> of$$$ <symbols> de*** <symbols>. <symbols>",
    "at at at at <word> <word>",
    "<word> <word> at at <word>, at <word>",
    "<word> at, at, at, at, <word>. At <word>.",
    "<word> at at. at at. at <word>",
    "At At At At <word> <word>",
    "<word> dot dot <word> at dot at <word>.",
    "<word> de de <word> de <word> org <word> net",
    "sum <number>.<small> and <number> <number> <word>",
)
COPIES = 24


class _Values:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def digits(self, n: int) -> str:
        return "".join(self.random.choice("0123456789") for _ in range(n))

    def word(self) -> str:
        n = self.random.randint(2, 9)
        return "".join(self.random.choice("abcdefghilmnoprstuvéüñ") for _ in range(n))

    def name(self) -> str:
        return re.sub("[^a-z]", "o", self.word())

    def value(self, kind: str) -> str:
        pick = self.random.choice
        if kind == "email":
            user, host, top = self.name(), self.name(), pick(("org", "com", "net"))
            at = pick(("@", "@", " [at] ", " (at) ", " at ", " AT "))
            dot = "." if at == "@" else pick((" [dot] ", " (dot) ", " dot ", " DOT "))
            return f"{user}{at}{host}{dot}{top}"
        if kind == "ip":
            return ".".join(str(self.random.randint(1, 255)) for _ in range(4))
        if kind == "card":
            return pick((" ", "-", "")).join(self.digits(4) for _ in range(4))
        a, b, c = self.digits(3), self.digits(3), self.digits(4)
        return pick((f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"+{self.digits(2)} {a} {b}{c}", f"0{a} {b} {c}", f"{a}.{b}.{c}"))

    def filler(self, name: str) -> str:
        pick = self.random.choice
        return {
            "word": self.word,
            "Word": lambda: self.word().capitalize(),
            "year": lambda: str(self.random.randint(1900, 2030)),
            "number": lambda: self.digits(self.random.randint(2, 7)),
            "small": lambda: str(self.random.randint(0, 99)),
            "version": lambda: ".".join(self.digits(1) for _ in range(3)),
            "symbols": lambda: self.word() + pick(("###", "&&&", "%%%", "$$$", "***", "!!")),
            "hex": lambda: "".join(pick("0123456789abcdef") for _ in range(32)),
        }[name]()


def labelled_sentences(seed: int = 11, copies: int = COPIES) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, [(start, end, kind)]) of every template, ``copies`` times with new values."""
    values, out = _Values(seed), []
    for _ in range(copies):
        for template in TEMPLATES:
            text, spans = "", []
            for part in re.split(r"(\{\w+\}|<\w+>)", template):
                if part.startswith("{"):
                    value = values.value(part[1:-1])
                    spans.append((len(text), len(text) + len(value), part[1:-1]))
                    text += value
                else:
                    text += values.filler(part[1:-1]) if part.startswith("<") else part
            out.append((text, spans))
    return out
