"""Personal data and secrets replaced by keyed surrogates.

1. Patterns find entities in the whole texts: e-mail, IP, phone, card and
   account numbers, access keys, passwords and hex tokens, names after a title,
   and what else in the same text mentions a name word found there.
2. An entity is its kind and its folded value: a name is one entity in whatever
   case, place and part of a full name it stands.  What its mentions tell (a
   gender by a title, a given name by the word after it) is settled once for the
   whole table and only shapes the surrogate.
3. The distinct entities get surrogates: characters drawn from an HMAC of the
   entity under the key, of the same kind in the same places (digits, letters
   by case and script, hex digits), with check digits and value ranges kept;
   a given name gets one of its gender, a family name one of its script.
4. Collision check: a surrogate that two entities share, or that is an entity
   itself, is drawn anew with the next number until none is left.  So different
   entities have different surrogates.
5. Every mention of an entity, in whatever document, gets its surrogate, in the
   case of the mention; titles stay.
"""

from __future__ import annotations

import hmac
import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import on_workers, stored

KEY = b"surrogates-1"
MAX_DRAWS = 64

#: Titles by language with the gender they tell, and given names.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
          "Mme": "f", "Señor": "m", "Señora": "f", "господин": "m", "госпожа": "f",
          "Dr": "any", "Prof": "any"}
GIVEN = {("m", "latin"): ("James", "Peter", "Martin", "Lucas", "Daniel", "Thomas", "Hugo", "Victor", "Simon", "Oscar"),
         ("f", "latin"): ("Anna", "Clara", "Julia", "Maria", "Laura", "Emma", "Sofia", "Helena", "Alice", "Nora"),
         ("m", "cyrillic"): ("Иван", "Пётр", "Андрей", "Павел", "Виктор"),
         ("f", "cyrillic"): ("Анна", "Мария", "Ольга", "Елена", "Вера")}
GIVEN |= {("any", script): GIVEN["m", script] + GIVEN["f", script] for script in ("latin", "cyrillic")}
#: Endings of made-up names that tell a gender.
ENDINGS = {("given", "f", "latin"): "na", ("given", "m", "latin"): "n", ("given", "f", "cyrillic"): "на", ("given", "m", "cyrillic"): "н",
           ("family", "f", "cyrillic"): "нова", ("family", "m", "cyrillic"): "нов"}
SYLLABLES = {"latin": "ba be bo da de do ga ka ke la le li lo ma me mi mo na ne no ra re ri ro sa se so ta te to va ve".split(),
             "cyrillic": "ба бо ва ве га да до за ка ке ла ле ли ма ме мо на не но ра ре ро са се со та те то".split()}

#: In this order; of entities that overlap the first found, then the longer, counts.
PATTERNS = (
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")),
    ("key", re.compile(r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)")),
    ("password", re.compile(r"(?i:(?<=password=)|(?<=password: )|(?<=passwd=))[^\s\"'&;]{4,}")),
    ("token", re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")),
    ("ipv6", re.compile(r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=(?:[0-9A-Fa-f]*:){4})(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]|\.\d)")),
    ("account", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("card", re.compile(r"(?<![\w-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    # a complete number ends before a blank, whatever follows; four bare groups of four are a card's form and no phone
    ("phone", re.compile(r"(?<![\w(+])(?:(?=[+(])|(?<!\d[ .-])(?!\d{4}(?:[ -]?\d{4}){3}))"
                         r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\w|[.-]\d)")),
)
_ONE_TITLE = "(?:" + "|".join(sorted({x for t in TITLES for x in (t, t.upper())}, key=len, reverse=True)) + r")\.? "
#: Titles in a row (Herr Dr.) before a word that isn't lower case.
_TITLE = re.compile(rf"(?<!\w)((?:{_ONE_TITLE})+)(?=[^\W\d_a-zа-я])")
_TOLD = {t.upper(): g for t, g in TITLES.items()}
#: A name word, or an initial with its dot.
_NAME_WORD = re.compile(r"([^\W\d_])\.(?!\w)|([^\W\d_][\w’'-]*)")
_MENTION = re.compile(r"[^\W\d_]\w*(?:[’'-]\w+)*")
_GENITIVE = re.compile(r"(?:[’']s|[’'-]+)\Z")
_ANY_DIGIT = re.compile(r"[0-9@]|AKIA|(?i:password[=:]|passwd=|[a-f]{32}|::)")
#: Kinds whose case says nothing: one surrogate, in the case of each mention.
CASELESS = ("email", "token", "ipv6")


def _luhn(digits: str) -> int:
    """The digit that makes ``digits`` + it pass the card checksum."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card_like(value: str) -> bool:
    digits = re.sub(r"\D", "", value)
    return 13 <= len(digits) <= 19 and _luhn(digits[:-1]) == int(digits[-1])


def _account_like(value: str) -> bool:
    """The checksum of an international account number."""
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _names(text: str) -> list[tuple[int, int, str, str, str, str]]:
    """The name words after titles, and every other whole-word mention of them in
    the text (but for initials): ``(start, end, kind, folded value, part, gender)``
    with the part (given, family) and the gender that this mention tells, if any."""
    out, known = [], set()
    for m in _TITLE.finditer(text):
        told = [g for t in re.findall(r"[^\W\d_]+", m[1]) if (g := _TOLD[t.upper()]) != "any"]
        words, at = [], m.end()
        while (w := _NAME_WORD.match(text, at)) and not (w[1] or w[2])[0].islower() and w.group().upper() not in _TOLD:
            value = w[1] or _GENITIVE.sub("", w[2])
            end, stop = at + len(value), w.end()        # an initial's dot stays
            words.append((at, end, value))
            if (not w[1] and end != stop) or not text.startswith(" ", stop):
                break
            at = stop + 1
        if len(words) == 1 and len(words[0][2]) == 1 and words[0][2].isascii():
            continue                        # an initial alone
        for i, (start, end, value) in enumerate(words):
            part = "given" if i + 1 < len(words) else "family"
            folded = value.casefold()
            if len(value) == 1:
                out.append((start, end, "initial", folded, "", ""))
                continue
            out.append((start, end, "name", folded, part, told[0] if told else ""))
            known.add(folded)
    if known:
        for m in _MENTION.finditer(text):
            value = m.group() if m.group().casefold() in known else _GENITIVE.sub("", m.group())
            if value.casefold() in known and not value[0].islower():
                out.append((m.start(), m.start() + len(value), "name", value.casefold(), "", ""))
    return out


def find(text: str | None) -> list[tuple[int, int, str, str, str, str]]:
    """``(start, end, kind, folded value, part, gender)`` of the entities of a text,
    in order and without overlaps.  Given and family name are entities of their
    own, so a person's family name alone and their full name stay one person's."""
    out: list[tuple[int, int, str, str, str, str]] = []
    if not text:
        return out
    if _ANY_DIGIT.search(text):
        for kind, pattern in PATTERNS:
            for m in pattern.finditer(text):
                if (kind == "card" and not _card_like(m.group())) or (kind == "account" and not _account_like(m.group())):
                    continue
                value = m.group().lower() if kind in CASELESS else m.group()
                out.append((m.start(), m.end(), kind, value, "", ""))
    out += _names(text)
    out.sort(key=lambda x: (x[0], -x[1], not x[4]))         # a mention that tells something before a bare one
    kept: list[tuple[int, int, str, str, str, str]] = []
    for x in out:
        if not kept or x[0] >= kept[-1][1]:
            kept.append(x)
    return kept


def script_of(value: str) -> str:
    return "cyrillic" if re.match(r"[Ѐ-ӿ]", value) else "latin"


#: Gender of the listed given names.
_LISTED = {n.casefold(): g for (g, _), names in GIVEN.items() if g != "any" for n in names}


def settled(value: str, parts: dict[str, int], genders: dict[str, int]) -> str:
    """The form of a name's surrogate, ``part-gender-script``, from how often its
    mentions in the table told each part and gender: a given name if it ever was
    one; the gender most often told, else that of a listed name, else any (a
    family name tells one in Cyrillic only)."""
    script = script_of(value)
    part = "given" if parts.get("given") else "family"
    told = sorted((-n, g) for g, n in genders.items() if n)
    gender = told[0][1] if told else _LISTED.get(value, "any")
    return f"{part}-{'any' if part == 'family' and script != 'cyrillic' else gender}-{script}"


def _draws(kind: str, value: str, draw: int, key: bytes) -> Iterator[int]:
    block = 0
    while True:
        for b in hmac.new(key, f"{kind}\0{value}\0{draw}\0{block}".encode("utf-8", "surrogatepass"), sha256).digest():
            yield b
        block += 1


def _like(c: str, d: int, hexed: bool) -> str:
    """A character of the same kind as ``c``."""
    if hexed and c in "0123456789abcdef":
        return "0123456789abcdef"[d % 16]
    if c.isdigit() and c.isascii():
        return str(d % 10)
    if "a" <= c <= "z":
        return chr(97 + d % 26)
    if "A" <= c <= "Z":
        return chr(65 + d % 26)
    return c


def _made_up(kind: str, value: str, draw: int, got: Iterator[int]) -> str:
    if kind.startswith(("given-", "family-")):
        part, gender, script = kind.split("-")
        if part == "given" and draw == 0:
            return GIVEN[gender, script][next(got) % len(GIVEN[gender, script])]
        parts = SYLLABLES[script]
        stem = "".join(parts[next(got) % len(parts)] for _ in range(2 + next(got) % 2 + draw // 4))
        return stem.capitalize() + ENDINGS.get((part, gender, script), "")
    if kind == "initial":                   # a letter of its script, more of them where letters run out
        letters = "абвгдежзиклмнопрстуфхцчшэюя" if script_of(value) == "cyrillic" else "abcdefghijklmnopqrstuvwxyz"
        return "".join(letters[next(got) % len(letters)] for _ in range(1 + draw // 8)).capitalize()
    if kind == "email":
        name, domain = value.rsplit("@", 1)
        host, _, top = domain.rpartition(".")
        name += "x" * (draw // 8)       # longer where short addresses run out
        return "".join(_like(c, next(got), False) for c in name) + "@" + "".join(_like(c, next(got), False) for c in host) + "." + top
    if kind == "ip":
        return ".".join(str(1 + (next(got) + 256 * next(got)) % 254) for _ in range(4))
    if kind == "account":
        country, body = value[:2], "".join(_like(c, next(got), False) for c in value[4:])
        rest = int("".join(str(int(c, 36)) for c in body.replace(" ", "") + country) + "00") % 97
        return f"{country}{98 - rest:02d}{body}"
    if kind == "key":
        return "AKIA" + "".join(_like(c, next(got), False) if not c.isdigit() else str(next(got) % 10) for c in value[4:])
    if kind == "card":
        out = value[0] + "".join(_like(c, next(got), False) for c in value[1:])
        at = max(i for i, c in enumerate(out) if c.isdigit())
        return out[:at] + str(_luhn(re.sub(r"\D", "", out[:at]))) + out[at + 1:]
    if kind == "phone" and value.startswith("+"):
        code = re.match(r"\+\d{1,3}", value).group()
        return code + "".join(_like(c, next(got), False) for c in value[len(code):])
    if kind == "password":              # one of signs alone becomes letters; longer where short ones run out
        value = (value if re.search(r"[0-9A-Za-z]", value) else "x" * len(value)) + "0" * (draw // 8)
    return "".join(_like(c, next(got), kind in ("token", "password", "ipv6")) for c in value)


def surrogate(kind: str, value: str, draw: int = 0, key: bytes = KEY) -> str:
    """The ``draw``-th replacement of an entity; never the entity itself."""
    got = _draws(kind, value, draw, key)
    while (out := _made_up(kind, value, draw, got)) == value:
        pass                            # the next characters of the same stream
    return out


def _as_written(kind: str, written: str, made: str) -> str:
    """The surrogate in the case that the mention has in the text."""
    if kind in ("name", "initial"):
        return made.upper() if len(written) > 1 and written == written.upper() else made
    if kind not in ("token", "ipv6") or written == written.lower():
        return made
    if written == written.upper():
        return made.upper()
    return "".join(m.upper() if w.isupper() else m for w, m in zip(written, made, strict=True))


def _detect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found = [[dict(zip(("s", "e", "kind", "value", "part", "gender"), x, strict=True)) for x in find(t)] for t in b["text"]]
        yield pd.DataFrame({"doc_id": b["doc_id"], "text": b["text"], "found": found})


def settle(mentions: DataFrame) -> DataFrame:
    """Distinct entities ``(kind, value, form)`` of ``(kind, value, part, gender)``:
    what a name's mentions in all documents tell, counted."""
    told = mentions.groupBy("kind", "value").agg(
        *[F.count(F.when(F.col("part") == p, 1)).alias(p) for p in ("given", "family")],
        *[F.count(F.when((F.col("gender") == g) & (F.col("part") == "given"), 1)).alias(f"given_{g}") for g in ("m", "f")],
        *[F.count(F.when(F.col("gender") == g, 1)).alias(f"any_{g}") for g in ("m", "f")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            form = []
            for r in b.itertuples(index=False):
                first = {"m": r.given_m, "f": r.given_f}
                form.append(settled(r.value, {"given": r.given, "family": r.family}, first if any(first.values()) else {"m": r.any_m, "f": r.any_f})
                            if r.kind == "name" else r.kind)
            yield pd.DataFrame({"kind": b["kind"], "value": b["value"], "form": form})

    return told.mapInPandas(run, "kind string, value string, form string")


def _draw(key: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(surrogate=[surrogate(f, v, d, key) for f, v, d in zip(b["form"], b["value"], b["draw"], strict=True)])
    return run


def surrogates(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """Distinct ``(kind, value, form)`` -> ``(kind, value, surrogate)``, all different
    from each other and from every entity, in whatever case."""
    cols = "kind string, value string, form string, draw int"
    now = entities.select("kind", "value", "form").withColumn("draw", F.lit(0))
    for _ in range(MAX_DRAWS):
        now = stored(now.select("kind", "value", "form", "draw").mapInPandas(_draw(key), cols + ", surrogate string")
                     .withColumn("folded", F.lower("surrogate")), "pii-surrogates")
        # the entity that sorts first keeps a shared surrogate; an entity's own text is never a surrogate
        first = now.groupBy("folded").agg(F.min(F.struct("draw", "kind", "value")).alias("first"), F.count(F.lit(1)).alias("c"))
        taken = (first.filter("c > 1").select("folded", "first").unionByName(
            first.select("folded", "first").join(now.select(F.lower("value").alias("folded")).distinct(), "folded", "left_semi")
            .withColumn("first", F.lit(None).cast(first.schema["first"].dataType))))
        taken = taken.groupBy("folded").agg(F.max(F.col("first").isNull()).alias("real"), F.max("first").alias("first"))
        again = F.col("real") | (F.struct("draw", "kind", "value") != F.col("first"))
        if not taken.limit(1).count():
            return now.select("kind", "value", "surrogate")
        now = now.join(taken, "folded", "left").withColumn(
            "draw", F.when(F.coalesce(again, F.lit(False)), F.col("draw") + 1).otherwise(F.col("draw")))
    raise RuntimeError(f"surrogates still collide after {MAX_DRAWS} draws")


def pseudonymise(docs: DataFrame, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, n_entities)``, one row per row of ``docs``.

    * Equal entities (names, e-mail addresses, IPv6 addresses and hex tokens in any
      case) have one surrogate in all documents, in the case of each mention (but
      for e-mail addresses); different entities of the table have different ones.
    * NULL and empty texts stay as they are, with 0 entities; repeated rows stay
      repeated; an empty table gives no rows.
    """
    on_workers(docs.sparkSession)
    found = stored(docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        _detect, "doc_id string, text string, found array<struct<s:int,e:int,kind:string,value:string,part:string,gender:string>>")
        .withColumn("row", F.monotonically_increasing_id()), "pii-found")
    each = found.filter(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.*")
    table = surrogates(stored(settle(each.select("kind", "value", "part", "gender")), "pii-entities"), key)
    # one row per document and entity meets its surrogate (AQE splits an entity that very many documents hold)
    named = (each.select("row", "kind", "value").distinct().join(table, ["kind", "value"])
             .groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct(
                 F.concat_ws("\x00", "kind", "value"), "surrogate"))).alias("names")))

    def splice(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for text, found_here, names in zip(b["text"], b["found"], b["names"], strict=True):
                names, out, last = dict(names), [], 0
                for x in found_here:
                    out += [text[last:x["s"]], _as_written(x["kind"], text[x["s"]:x["e"]], names[f"{x['kind']}\x00{x['value']}"])]
                    last = x["e"]
                texts.append("".join(out) + text[last:])
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": texts, "n_entities": [len(x) for x in b["found"]]})

    changed = (found.filter(F.size("found") > 0).join(named, "row").select("doc_id", "text", "found", "names")
               .mapInPandas(splice, "doc_id string, text string, n_entities long"))
    same = found.filter(F.size("found") == 0).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"))
    return same.unionByName(changed).withColumn("doc_id", F.col("doc_id").cast("long"))
