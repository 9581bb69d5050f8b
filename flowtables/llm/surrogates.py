"""Personal data replaced by keyed surrogates of the same kind and format.

Entities are found by patterns, reduced to a normal form (an e-mail address in
lower case, a phone number's digits), and each distinct one gets a surrogate made
from a keyed hash: same kind, same lengths, same script; names keep their gender.
Surrogates that two entities would share, or that are somebody's real entity, are
made anew with the next attempt until all differ. So equal entities are replaced
alike everywhere and different ones stay different.

DataFrame functions only. The table of entities is spread like any other. Texts are
searched once; those without a mention go straight to the result, and only the
others meet the replacements of their own mentions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.llm.common import stored

# ---- fixed values: kinds in the order in which they are looked for, with their patterns
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ipv4": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "access_key": r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "hex_token": r"(?<![0-9A-Za-z])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])",
    # what is assigned to a name that speaks of a secret
    "secret": r"(?<=[=:\"' ])(?<=(?i:password|passwd|secret|token|api_key|apikey)\s{0,2}[=:]\s{0,2}[\"']{0,1})[A-Za-z0-9_+/-]{6,}+",
}
GIVEN_NAMES = {
    ("f", "latin"): ["Alice", "Anna", "Carmen", "Claire", "Elena", "Emma", "Hannah", "Julia", "Laura", "Lucia", "Maria", "Sophie"],
    ("m", "latin"): ["Carlos", "Daniel", "David", "Hans", "James", "Jean", "John", "Luis", "Michael", "Paul", "Peter", "Thomas"],
    ("f", "cyrillic"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"],
    ("m", "cyrillic"): ["Антон", "Иван", "Михаил", "Николай", "Павел", "Юрий"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "hal", "kin", "lor", "mar", "nes", "pol", "rin", "sel", "tan", "ver", "wes", "zan"],
    "cyrillic": ["ба", "ве", "го", "ди", "ка", "ле", "ми", "но", "по", "ри", "са", "ти", "фа", "хо", "ша", "яр"],
}
# ---- end of fixed values
_NAMES = "|".join(n for names in GIVEN_NAMES.values() for n in names)
PATTERNS["person"] = rf"(?<!\p{{L}})(?:{_NAMES}) \p{{Lu}}\p{{Ll}}+(?!\p{{L}})"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
ATTEMPTS = 60


def kind_of(mention: Column) -> Column:
    """The first kind whose pattern fits; a secret is known by what stands before it, so what fits none is one."""
    out = F.lit("secret")
    for kind, pattern in reversed(PATTERNS.items()):
        if kind == "secret":
            continue
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def normal_form(kind: Column, mention: Column) -> Column:
    """What makes two mentions the same entity."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return F.when(kind.isin("email", "hex_token"), F.lower(mention)).when(kind.isin("card", "phone", "ssn"), digits).otherwise(mention)


def _number(seed: Column, at) -> Column:
    """A number from 0 to 65535 from 4 of the 128 hex digits of ``seed``."""
    return F.conv(F.substring(seed, (F.lit(at) % 31) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _like(value: Column, seed: Column, letters: bool = True) -> Column:
    """Digits for digits, small letters for small ones, capitals for capitals; the rest stays."""
    digits, small, large = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def swap(c: Column, i: Column) -> Column:
        n = _number(F.sha2(F.concat(seed, i.cast("string")), 512), 0)
        pick = lambda chars: F.substring(F.lit(chars), n % len(chars) + 1, F.lit(1))
        out = F.when(c.between("0", "9"), pick(digits))
        return out.when(c.between("a", "z"), pick(small)).when(c.between("A", "Z"), pick(large)).otherwise(c) if letters else out.otherwise(c)

    return F.array_join(F.transform(_characters(value), swap), "")


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _luhn(digits: Column) -> Column:
    """Check sum modulo 10 of a string of 16 digits."""
    doubled = F.transform(_characters(digits), lambda c, i: F.when(i % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda total, d: total + d.cast("long")) % 10


def _octet(value: Column, n: Column, wide: Column) -> Column:
    """An octet of as many digits; any octet where that space is used up."""
    size = F.length(value)
    return F.when(wide, n % 254 + 1).when(size == 1, n % 9 + 1).when(size == 2, n % 90 + 10).otherwise(n % 156 + 100).cast("string")


def _person(value: Column, seed: Column, attempt: Column) -> Column:
    """A given name of the same gender and a surname of four syllables, one more after every eight attempts."""
    given = F.substring_index(value, " ", 1)
    out = value
    for (_, script), names in GIVEN_NAMES.items():
        part = lambda i, s=script: F.element_at(F.array(*[F.lit(x) for x in SYLLABLES[s]]), _number(seed, i) % len(SYLLABLES[s]) + 1)
        first = F.element_at(F.array(*[F.lit(x) for x in names]), _number(seed, 0) % len(names) + 1)
        further = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(attempt / 8).cast("int")), lambda i: F.when(i > 0, part(i + 4)).otherwise(F.lit(""))), "")  # noqa: B023
        surname = F.initcap(F.concat(part(1), part(2), part(3), part(4), further))
        out = F.when(given.isin(names), F.concat_ws(" ", first, surname)).otherwise(out)
    return out


def surrogate(kind: Column, value: Column, secret: str, attempt: Column) -> Column:
    """Surrogate of a normal form."""
    seed = F.sha2(F.concat_ws("|", F.lit(secret), kind, value, attempt.cast("string")), 512)
    wide = attempt > ATTEMPTS // 2
    domain, local = F.substring_index(value, "@", -1), F.substring_index(value, "@", 1)
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    extra = F.when(wide, F.substring(seed, 1, 8)).otherwise(F.lit(""))
    email = F.concat(_like(local, seed), extra, F.lit("@"), _like(host, F.concat(seed, F.lit("h"))), top)
    body = F.concat(F.substring(value, 1, 1), _like(F.substring(value, 2, 14), seed, letters=False))
    gap = F.pmod(_luhn(value) - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    card = F.concat(body, gap.cast("string"))
    # a number keeps its country code; area and exchange do not begin with 0 or 1
    tail = F.substring(value, F.length(value) - 9, F.lit(10))
    spread = _like(tail, seed, letters=False)
    lead = lambda at: (_number(seed, at) % 8 + 2).cast("string")
    phone = F.concat(F.substring(value, F.lit(1), F.length(value) - 10), lead(1), F.substring(spread, 2, 2), lead(2), F.substring(spread, 5, 6))
    ssn = F.concat((_number(seed, 1) % 8 + 1).cast("string"), F.substring(_like(value, seed, letters=False), 2, 8))
    ip = F.array_join(F.transform(F.split(value, r"\."), lambda o, i: _octet(o, F.conv(F.substring(seed, i * 4 + 1, F.lit(4)), 16, 10).cast("int"), wide)), ".")
    key = F.concat(F.lit("AKIA"), _like(F.substring(value, 5, 16), seed))
    # 128 digits from each hash; the first is the seed itself
    further = F.transform(F.sequence(F.lit(1), F.floor((F.length(value) - 1) / 128).cast("int")), lambda i: F.sha2(F.concat(seed, i.cast("string")), 512))
    digits = F.when(F.length(value) > 128, F.concat(seed, F.array_join(further, ""))).otherwise(seed)
    token = F.substring(digits, F.lit(1), F.length(value))
    made = {"secret": _like(value, seed), "email": email, "card": card, "phone": phone, "ssn": ssn, "ipv4": ip, "access_key": key, "hex_token": token, "person": _person(value, seed, attempt)}
    out = F.lit(None).cast("string")
    for name, column in made.items():
        out = F.when(kind == name, column).otherwise(out)
    return out


def laid_out(kind: Column, mention: Column, made: Column) -> Column:
    """A surrogate in the format of a mention."""
    gaps, digits = F.split(mention, "[0-9]", -1), _characters(made)
    filled = F.array_join(F.flatten(F.zip_with(gaps, digits, lambda g, d: F.array(F.coalesce(g, F.lit("")), F.coalesce(d, F.lit(""))))), "")
    shouted = (mention == F.upper(mention)) & (mention != F.lower(mention))
    mixed = F.array_join(F.zip_with(_characters(mention), _characters(made), lambda m, c: F.when(m.between("A", "F"), F.upper(c)).otherwise(c)), "")
    out = F.when(kind.isin("card", "phone", "ssn"), filled).when(kind.isin("email", "hex_token") & shouted, F.upper(made))
    return out.when((kind == "hex_token") & (mention != F.lower(mention)), mixed).otherwise(made)


def _longer(made: Column, attempt: Column) -> Column:
    """Beyond ``ATTEMPTS`` a format has no room for all its entities; its surrogates then get digits more, so that there is an end."""
    return F.when(attempt > ATTEMPTS, F.concat(made, F.substring(F.conv(F.substring(F.md5(F.concat(made, attempt.cast("string"))), 1, 15), 16, 10), 1, 12))).otherwise(made)


def entity_table(entities: DataFrame, secret: str) -> DataFrame:
    """kind, value, made: a different surrogate for each distinct (kind, value), none of them a value of that kind."""
    settled = None
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    waiting = stored(entities.distinct().withColumn("attempt", F.lit(0)), "entities")
    real = waiting.select(F.col("kind").alias("k"), F.col("value").alias("v"))
    while not waiting.isEmpty():
        spread = waiting.repartition(tasks, "kind", "value")
        tried = stored(spread.withColumn("made", _longer(surrogate(F.col("kind"), F.col("value"), secret, F.col("attempt")), F.col("attempt"))), "tried")
        first = tried.groupBy("kind", "made").agg(F.min("value").alias("value"))
        free = first.join(real, (F.col("kind") == F.col("k")) & (F.col("made") == F.col("v")), "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "made"), ["kind", "made"], "left_anti")
        free = free.select("kind", "value", "made")
        settled = stored(free if settled is None else settled.unionByName(free), "settled")
        waiting = stored(tried.drop("made").join(settled, ["kind", "value"], "left_anti").withColumn("attempt", F.col("attempt") + 1), "waiting")
    return entities.sparkSession.createDataFrame([], "kind string, value string, made string") if settled is None else settled


def replaced(docs: DataFrame, secret: str) -> DataFrame:
    """``docs`` with surrogates in ``text`` and a column ``n_entities`` (replaced if there is one).

    All rows and other columns, of any names, stay. A null text stays null with no entities, an
    empty one empty. Mentions do not overlap: at each place the first kind of
    ``PATTERNS`` that fits counts. Rows alike get the same text. Documents in
    which nothing is found are given back unchanged, and are not shuffled.
    An empty table gives an empty table.
    """
    kept = [c for c in docs.columns if c != "n_entities"]
    found = F.regexp_extract_all("text", F.lit(ANY), 0)
    rows = stored(docs.select(F.struct(*kept).alias("doc"), F.monotonically_increasing_id().alias("row"), found.alias("found")), "searched")
    hit = F.coalesce(F.size("found") > 0, F.lit(False))
    said = rows.where(hit).select("row", F.explode(F.array_distinct("found")).alias("mention"))
    entities = said.select("mention").distinct().withColumn("kind", kind_of(F.col("mention")))
    entities = stored(entities.withColumn("value", normal_form(F.col("kind"), F.col("mention"))), "mentions")
    table = entity_table(entities.select("kind", "value"), secret)
    changes = stored(entities.join(table, ["kind", "value"]).select("mention", laid_out(F.col("kind"), F.col("mention"), F.col("made")).alias("new")), "changes")
    per_row = said.join(changes.hint("merge"), "mention").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias("changes"))
    rewritten = rows.where(hit).join(per_row.hint("merge"), "row")
    news = F.transform("found", lambda m: F.element_at("changes", m))
    pieces = F.split("doc.text", ANY, -1)
    text = F.array_join(F.flatten(F.zip_with(pieces, news, lambda p, n: F.array(F.coalesce(p, F.lit("")), F.coalesce(n, F.lit(""))))), "")
    untouched = rows.where(~hit).select("doc.*", F.lit(0).alias("n_entities"))
    changed = rewritten.withColumn("doc", F.col("doc").withField("text", text)).select("doc.*", F.size("found").alias("n_entities"))
    return untouched.unionByName(changed)
