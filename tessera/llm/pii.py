"""Surrogates for personal data, with DataFrame functions only.

Detection is one regular expression over the whole text. Each distinct entity of the corpus gets one surrogate,
made from a keyed hash (SHA-256 over key, type, entity and attempt), so every mention of an entity, in any
document and in any notation that has the same normal form, gets the same replacement, and a run with
the same key repeats it. Surrogates keep the type and its checks (octets of an address, the Luhn digit of a
card number), format (separators, lengths, letter case), and for names gender and script.

Distinctness is checked over the corpus: entities whose surrogates meet, or whose surrogate is an entity of the
corpus, are drawn again under the next attempt, the first entity in order keeping its own, until none meet.
Only distinct entities take part, and only their surrogates and the mentions are shuffled; a mention's join on its
entity is between written tables, which Spark splits where an entity has a large part of all mentions.

Types: email, phone (international, or ten digits in groups of three, three and four, which count as numbers of +1), card
(13 to 19 digits with a right Luhn digit), ipv4, ssn, secret (access keys, assigned passwords and tokens), name (a title and
one to three capitalised words). A given name and a surname are entities of their own, so that a person's full
name and surname alone stay in agreement; gender comes from the titles of all mentions of a name.

A capitalised word that is part of a name with a title in the same document is a mention too: words between the first
mentions are joined with the document's name parts. Possessive endings (and lower-case ones after a hyphen) stay. A name without
a title anywhere in its document, and one written in lower case, isn't recognised.

Null texts stay null, empty ones empty. Documents are told apart by id and text; rows that repeat both get the same
result. A text without entities comes back as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, table
from tessera.operators.joins import broadcastable
from tessera.session import cut_lineage

# Titles by gender, and the syllables and endings that names of a script are made of.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Signor", "господин", "κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Signora", "госпожа", "κυρία"]
NEUTRAL = ["Dr", "Prof", "Professor"]
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa".split(),
    "cyrillic": "ба бе бо ва ве га го да де ди до за ка ке ко ла ле ли ло ма ме ми мо на не ни но па ра ре ро са".split(),
    "greek": "βα βε γα γε δα δε ζα θα θε κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα ρα ρε ρι ρο σα σε".split(),
}
GIVEN = {"latin": ("n", "na", "l"), "cyrillic": ("н", "на", "ль"), "greek": ("ς", "να", "ν")}
FAMILY = {"latin": ("ner", "ner", "ner"), "cyrillic": ("нов", "нова", "нко"), "greek": ("δης", "δου", "κη")}
GENDERS = ("m", "f", "n")

TITLE = r"(?<![\p{L}\p{N}])(?:" + "|".join(MALE + FEMALE + NEUTRAL) + r")\.? "
WORD = r"(?<![\p{L}\p{N}_])\p{Lu}[\p{L}'’-]+"
TAIL = r"(?:['’][sS]?|-+\p{Ll}[\p{L}'’-]*|-+)$"
NAME = TITLE + r"\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}"
PATTERNS = {
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
              r"|(?<=password=|passwd=|token=|secret=|api_key=|token = \"|password = \"|secret = \"|api_key = \")[0-9A-Za-z_+/.-]{8,}",
    "email": r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "ipv4": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:(?:[ .-]?\d{3,4}){2}|(?:[ .-]?\d{2}){4})(?!\w)"
             r"|(?<![\w+-])(?<!\d\.)(?:1[ .-])?(?:\(\d{3}\) ?\d{3}[ .-]|\d{3}-\d{3}-|\d{3}\.\d{3}\.)\d{4}(?![\w-]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?![\w-])",
    "name": NAME,
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DIGITS = ("phone", "ssn", "card")
ATTEMPTS = 64


def may_hold(text: Column) -> Column:
    """False only for texts that no pattern can match: all need a digit, an at or equals sign, the start of an access key,
    or a title. That is much cheaper to see than that the patterns don't match."""
    out = F.rlike(text, F.lit("[0-9@=]")) | F.contains(text, F.lit("AKIA"))
    for t in MALE + FEMALE + NEUTRAL:
        out = out | F.contains(text, F.lit(t))
    return out


def luhn_sum(digits: Column, skip: int) -> Column:
    """Sum of the Luhn digits, leaving out the last ``skip``; the last of all is a plain one."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n - skip), lambda i: F.struct(F.substring(digits, i, F.lit(1)).cast("int").alias("d"), ((n - i) % 2).alias("twice")))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: (a + x["d"] * (1 + x["twice"]) - F.when((x["twice"] == 1) & (x["d"] > 4), 9).otherwise(0)).cast("long"))


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def type_of(raw: Column) -> Column:
    """The type of a mention: the first pattern that matches the whole of it; null for a number that isn't a card."""
    kind = F.lit(None).cast("string")
    if_named = {k: F.rlike(raw, F.lit(f"^(?:{p})$")) for k, p in PATTERNS.items() if k not in ("secret", "card")}
    card = F.rlike(raw, F.lit(r"^\d(?:[ -]?\d){12,18}$"))
    kind = F.when(card, F.when(luhn_sum(digits_of(raw), 0) % 10 == 0, "card"))
    for k in ("name", "ssn", "phone", "ipv4", "email"):
        kind = F.when(if_named[k], F.lit(k)).otherwise(kind)
    return F.when(card | if_named["name"] | if_named["ssn"] | if_named["phone"] | if_named["ipv4"] | if_named["email"], kind).otherwise("secret")


def hash_at(stream: Column, i: Column, n: int) -> Column:
    """A number below ``n`` from place ``i`` of a stream of hex digits, four to a place."""
    return (F.conv(F.substring(stream, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % n).cast("int")


def stream(seed: Column, places: Column) -> Column:
    """Hex digits for so many places."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(places / 16).cast("int")), lambda b: F.sha2(F.concat_ws("|", seed, b.cast("string")), 256)), "")


def pick(values: str, at: Column) -> Column:
    return F.substring(F.lit(values), at + 1, F.lit(1))


def refill(value: Column, hashes: Column, keep: Column) -> Column:
    """``value`` with each ASCII letter and digit after the first ``keep`` replaced by another of its class."""
    def one(i: Column) -> Column:
        c = F.substring(value, i + 1, F.lit(1))
        return (F.when(i < keep, c).when(c.between("0", "9"), pick("0123456789", hash_at(hashes, i, 10)))
                .when(c.between("a", "z"), pick("abcdefghijklmnopqrstuvwxyz", hash_at(hashes, i, 26)))
                .when(c.between("A", "Z"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", hash_at(hashes, i, 26))).otherwise(c))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.length(value) - 1), one), "")


def script_of(c: Column) -> Column:
    return F.when(F.rlike(c, F.lit(r"\p{IsCyrillic}")), "cyrillic").when(F.rlike(c, F.lit(r"\p{IsGreek}")), "greek").otherwise("latin")


def made_name(hashes: Column, role: Column, gender: Column, script: Column, attempt: int) -> Column:
    """A name of two syllables or more and an ending that fits role, gender and script; longer after some attempts."""
    out = F.lit(None).cast("string")
    for s, syllables in SYLLABLES.items():
        parts = [F.element_at(F.array(*map(F.lit, syllables)), hash_at(hashes, F.lit(i), len(syllables)) + 1) for i in range(2 + (attempt + 1) // 2)]
        body = F.concat(*parts)
        for k, g in enumerate(GENDERS):
            end = F.when(role == "given", GIVEN[s][k]).otherwise(FAMILY[s][k])
            out = F.when((script == s) & (gender == g), F.initcap(F.concat(body, end))).otherwise(out)
    return out


def hashed(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    """``entities`` with the hash streams that :func:`surrogate` reads, as columns, so that each is made once. A mail
    domain has one of its own: mailboxes that share a domain still do, and attempts change the mailbox only."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), "type", "norm", "role", F.lit(str(attempt))), 256)
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.substring_index("norm", "@", -1)), 256)
    return cut_lineage(entities.select("*", stream(seed, F.length("norm") + 40).alias("hashes"),
                                       F.when(F.col("type") == "email", stream(domain, F.length("norm"))).alias("own")))


def surrogate(type_: Column, norm: Column, role: Column, gender: Column, hashes: Column, own: Column, attempt: int) -> Column:
    """The normal form that stands for an entity, as of this attempt."""
    at = F.locate("@", norm)
    domain = F.substring(norm, at + 1, F.length(norm))
    host = F.regexp_extract(domain, r"^(.*)\.[^.]+$", 1)
    mail = F.concat(refill(F.substring(norm, F.lit(1), at - 1), hashes, F.lit(0)), F.lit("@"), refill(host, own, F.lit(0)),
                    F.substring(domain, F.length(host) + 1, F.length(domain)))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (1 + hash_at(hashes, i, 254)).cast("string")), ".")
    card = F.substring(refill(norm, hashes, F.lit(1)), F.lit(1), F.length(norm) - 1)
    # With a zero in the last place: what it lacks to a multiple of ten.
    card = F.concat(card, ((10 - luhn_sum(F.concat(card, F.lit("0")), 0) % 10) % 10).cast("string"))
    return (F.when(type_ == "email", mail).when(type_ == "ipv4", octets).when(type_ == "card", card)
            .when(type_ == "name", F.lower(made_name(hashes, role, gender, script_of(norm), attempt)))
            .when(type_ == "phone", refill(norm, hashes, F.lit(1)))
            .when((type_ == "secret") & F.rlike(norm, F.lit("^[0-9a-f]+$")), F.substring(hashes, F.lit(1), F.length(norm))).when(type_ == "secret", refill(norm, hashes, F.when(norm.startswith("AKIA"), 4).otherwise(0)))
            .otherwise(refill(norm, hashes, F.lit(0))))


def shaped(type_: Column, raw: Column, new: Column) -> Column:
    """A surrogate's normal form in the notation of a mention."""
    # A national number lacks the first digit of its normal form.
    start = F.struct(F.lit("").alias("out"), (F.length(new) - F.length(digits_of(raw)) + 1).alias("at"))
    filled = F.aggregate(F.split(raw, ""), start, lambda a, c: F.struct(
        F.concat(a["out"], F.when(c.between("0", "9"), F.substring(new, a["at"], F.lit(1))).otherwise(c)).alias("out"),
        (a["at"] + F.when(c.between("0", "9"), 1).otherwise(0)).alias("at")), lambda a: a["out"])
    cased = F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw)), lambda i: F.when(
        F.substring(raw, i, F.lit(1)).between("A", "Z"), F.upper(F.substring(new, i, F.lit(1)))).otherwise(F.substring(new, i, F.lit(1)))), "")
    name = F.when(raw == F.upper(raw), F.upper(new)).otherwise(F.initcap(new))
    return F.when(type_.isin(*DIGITS), filled).when(type_ == "email", cased).when(type_ == "name", name).otherwise(new)


def mentions(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """``(doc, text_hash, at, part, head, type, role, gender, raw, tail, norm)``: a row for each part of each mention. ``head`` is
    what stands before the part and stays, ``tail`` what stands behind it."""
    found = docs.where(may_hold(F.col(text))).select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("text_hash"), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)).alias("all"))
    rows = found.where(F.size("all") > 0).select("doc", "text_hash", F.posexplode("all").alias("at", "mention")).withColumn("type", type_of(F.col("mention")))
    title = F.regexp_extract("mention", f"^(?:{TITLE})", 0)
    words = F.split(F.substring("mention", F.length(title) + 1, F.length("mention")), " ")
    parts = F.when(F.col("type") == "name", words).otherwise(F.array("mention"))
    rows = rows.select("doc", "text_hash", "at", "type", title.alias("title"), F.size(parts).alias("n"), F.posexplode(parts).alias("part", "raw"))
    tail = F.when(F.col("type") == "name", F.regexp_extract("raw", TAIL, 0)).otherwise("")
    rows = rows.withColumn("tail", F.coalesce(tail, F.lit(""))).withColumn("raw", without_tail())
    bare = F.regexp_replace("title", r"[. ]", "")
    gender = F.when(bare.isin(*MALE), "m").when(bare.isin(*FEMALE), "f").otherwise("n")
    digits = digits_of(F.col("raw"))
    national = (F.col("type") == "phone") & (F.length(digits) == 10) & ~F.startswith("raw", F.lit("+"))
    norm = F.when(national, F.concat(F.lit("1"), digits)).when(F.col("type").isin(*DIGITS), digits).when(F.col("type").isin("email", "name"), F.lower("raw")).otherwise(F.col("raw"))
    role = F.when(F.col("type") == "name", F.when(F.col("part") + 1 == F.col("n"), "family").otherwise("given")).otherwise("")
    head = F.when(F.col("type") != "name", "").when(F.col("part") == 0, F.col("title")).otherwise(" ")
    return rows.select("doc", "text_hash", "at", "part", F.coalesce(head, F.lit("")).alias("head"), "type", role.alias("role"), gender.alias("gender"), "raw", "tail", norm.alias("norm"))


def without_tail() -> Column:
    return F.substring(F.col("raw"), F.lit(1), F.length("raw") - F.length("tail"))


def bare_names(docs: DataFrame, seen: DataFrame, new: DataFrame, text: str, id_col: str) -> DataFrame:
    """``(doc, text_hash, at, part, type, before, new, tail)`` for the documents with names: what stands before each mention ``at``,
    and behind the last, cut behind each capitalised word, with surrogates for the words that are part of a name of the document.
    ``seen`` are the mentions, ``new`` the surrogates of :func:`assign`."""
    names = seen.where("type = 'name'")
    same = ["type", "role", "norm"]
    # A word that is a given name and a surname in one document counts as the surname.
    known = names.groupBy("doc", "text_hash", "type", "norm").agg(F.min("role").alias("role")).join(new, same)
    known = cut_lineage(known.select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("norm").alias("_norm"), F.col("new").alias("_new")))
    whose = known.select("_doc", "_hash").distinct()
    side = F.broadcast(whose) if broadcastable(whose, 500_000, 64 << 20) else whose
    mine = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    own = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("body")).join(side, mine, "left_semi")
    gaps = own.dropDuplicates(["doc", "text_hash"]).select("doc", "text_hash", F.posexplode(F.split("body", ANY, -1)).alias("at", "gap"))
    # One piece more than words: the last has none behind it.
    both = gaps.select("doc", "text_hash", "at", F.split("gap", WORD, -1).alias("before"), F.regexp_extract_all("gap", F.lit(WORD), F.lit(0)).alias("raw"))
    rows = both.select("doc", "text_hash", "at", F.posexplode(F.arrays_zip("before", "raw")).alias("part", "x")).select(
        "doc", "text_hash", "at", "part", "x.before", F.coalesce("x.raw", F.lit("")).alias("raw"))
    rows = rows.withColumn("tail", F.regexp_extract("raw", TAIL, 0)).withColumn("raw", without_tail()).withColumn("norm", F.lower("raw"))
    near = F.broadcast(known) if broadcastable(known, 500_000, 64 << 20) else known
    rows = rows.join(near, mine & (F.col("norm") == F.col("_norm")), "left")
    kind = F.when(F.col("_new").isNotNull(), F.lit("name"))
    return rows.select("doc", "text_hash", "at", "part", kind.alias("type"), "before", F.coalesce(shaped(F.lit("name"), F.col("raw"), F.col("_new")), "raw").alias("new"), "tail")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(type, role, norm, new)``: distinct surrogates for distinct entities ``(type, role, norm, gender)``."""
    same = ["type", "role", "norm"]
    open_, done = entities, None
    real = entities.select(F.col("type").alias("_t"), F.col("norm").alias("_n")).distinct()
    for attempt in range(ATTEMPTS):
        made = hashed(open_, key, attempt)
        made = made.withColumn("new", surrogate(*map(F.col, ("type", "norm", "role", "gender", "hashes", "own")), attempt))
        made = cut_lineage(made.join(real, (F.col("type") == F.col("_t")) & (F.col("new") == F.col("_n")), "left")
                           .select(*entities.columns, "new", F.col("_n").isNotNull().alias("taken")))
        if done is not None:
            had = done.select(F.col("type").alias("_t"), F.col("new").alias("_n")).distinct()
            made = cut_lineage(made.join(had, (F.col("type") == F.col("_t")) & (F.col("new") == F.col("_n")), "left")
                               .select(*entities.columns, "new", (F.col("taken") | F.col("_n").isNotNull()).alias("taken")))
        first = made.where("not taken").groupBy("type", "new").agg(F.min(F.struct("norm", "role")).alias("first"))
        kept = cut_lineage(made.where("not taken").join(first, ["type", "new"]).where("norm = first.norm and role = first.role").select(*same, "new"))
        done = kept if done is None else done.unionByName(kept)
        open_ = cut_lineage(open_.join(kept, same, "left_anti"))
        if open_.isEmpty():
            return done
    raise ValueError(f"no distinct surrogates for some entities after {ATTEMPTS} attempts")


#: The columns that :func:`replace` adds.
ADDED = ("_clean", "_found")


def replace(docs: DataFrame, key: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``_clean`` (the text with surrogates) and ``_found`` (``array<struct<type, surrogate>>`` in order).
    Columns of those names in ``docs`` are replaced; all others stay, whatever their names."""
    # Numbers that merely look like a card have no type and stay as they are.
    seen = cut_lineage(mentions(docs, text, id_col))
    entities = seen.where("type is not null").groupBy("type", "role", "norm").agg(F.min("gender").alias("gender"))  # f or m before n
    table_ = cut_lineage(assign(cut_lineage(entities), key))
    near = F.broadcast(table_) if broadcastable(table_, 500_000, 64 << 20) else table_
    new = seen.join(near, ["type", "role", "norm"], "left").select(
        "doc", "text_hash", "at", "part", "type", F.coalesce(shaped(F.col("type"), F.col("raw"), F.col("new")), "raw").alias("new"), F.col("head").alias("before"), "tail")
    new = new.withColumn("gap", F.lit(False)).unionByName(bare_names(docs, seen, near, text, id_col).withColumn("gap", F.lit(True)))
    # What stands before a mention sorts before it.
    words = F.array_sort(F.collect_set(F.struct("at", (~F.col("gap")).alias("entity"), "part", "before", "new", "tail", "type")))
    doc, hash_, parts, whole, gaps = fresh(docs, "doc", "hash", "parts", "whole", "gaps")
    each = new.groupBy("doc", "text_hash").agg(words.alias(parts), F.max("gap").alias(whole))
    # A mention's parts follow each other; those after the first are joined on without a piece of text between.
    per = cut_lineage(each.select(F.col("doc").alias(doc), F.col("text_hash").alias(hash_), parts, whole))
    side = F.broadcast(per) if broadcastable(per, 500_000, 64 << 20) else per
    mine = docs[id_col].eqNullSafe(F.col(doc)) & (F.xxhash64(docs[text]) == F.col(hash_))
    own = [c for c in docs.columns if c not in ADDED]
    both = docs.join(side, mine, "left").select(*[docs[c] for c in own], docs[text].alias(doc), parts, whole, F.when(~F.col(whole), F.split(docs[text], ANY, -1)).alias(gaps))
    gap = lambda p: F.when(~F.col(whole) & (p["part"] == 0), F.get(F.col(gaps), p["at"])).otherwise("")
    filled = F.transform(parts, lambda p: F.concat(gap(p), p["before"], p["new"], p["tail"]))
    clean = F.concat(F.array_join(filled, ""), F.when(F.col(whole), "").otherwise(F.element_at(gaps, -1)))
    named = F.transform(F.filter(parts, lambda p: p["type"].isNotNull()), lambda p: F.struct(p["type"].alias("type"), p["new"].alias("surrogate")))
    return both.select(*own, F.when(F.col(parts).isNull(), F.col(doc)).otherwise(clean).alias("_clean"),
                       F.coalesce(named, F.array().cast("array<struct<type:string,surrogate:string>>")).alias("_found"))


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Every document with surrogates for the personal data in it."""
    found = replace(table(spark, sf_dir, "documents"), key="corpus-surrogates-1")
    return found.select("doc_id", F.col("_clean").alias("text"), F.size("_found").alias("n_entities"), F.col("_found").alias("surrogates"))
