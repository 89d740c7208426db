"""Personal data in documents, replaced by keyed surrogates of the same kind and format.

Detection and replacement are SQL functions only. Distinct values are few beside
their occurrences, so surrogates are made once per distinct value: letters and
digits are drawn from a keyed hash of the value and take the place of letters
and digits, vowels for vowels, in the same script; a given name ends as names of
its gender do; a card number passes the check of its last digit, an address
keeps its top-level domain, a phone number its country, octets stay octets. Case,
separators and titles are those of the occurrence.

Values that differ only in case or separators are one value and get one
surrogate in all documents (coreference). A surrogate that two values of a kind
would share, or that is itself a value found in the documents, is drawn again
for all but one of them, until all are distinct: after some attempts surrogates
grow, and after ``ENDING`` they take in 128 bits of their hash, so this ends whatever
the values are. A secret without a letter or digit is no entity.

Occurrences meet their surrogates in a join on the found string; the values, not
the occurrences, are joined to build the table, and a value found in a third of
all documents is one row of it.

Nulls: a null text stays null and holds nothing. Repeated rows get equal
results. The whole text is searched. Digits of card length that fail the card
check are no entity. An empty table gives an empty result. Further columns pass
through; one that is named like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattspan.llm.staging import id_or_last, staged, table, text_of

# Titles by gender, and the kinds of entities with their patterns.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "господин", "г-н", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "госпожа", "г-жа", "κυρία")
OPEN = ("Dr", "Prof", "Mx")
TITLES = "|".join(sorted({x for t in MALE + FEMALE + OPEN for x in (t, t.upper())}, key=lambda t: (-len(t), t)))
GAP = r"[ \t]{1,4}"
NAME = r"\p{Lu}[\p{L}'’-]++"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
SECRET = r"(?i:password|passwd|secret|token|api[_-]?key)[\"']?[ \t]{0,4}[=:][ \t]{0,4}"
BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
KEY = r"(?:AKIA|(?:ghp|gho|ghs|github_pat|sk_live|sk_test|rk_live|xoxb|xoxp)[_-])"
COUNTRY = r"^\+(?:\d{1,3}(?=[ .(-])|[17]|\d{2})"
GROUP = r"[ .-]?\d{1,4}"
KINDS = {
    "private_key": BLOCK + r"[^-]++-----END [A-Z ]{0,40}PRIVATE KEY-----",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "secret": r"(?<![\p{L}\d])" + SECRET + r"""(?:"[^"\n]{6,}+"|'[^'\n]{6,}+'|[^\s"']{6,}+)""",
    "access_key": r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|" + KEY + r"[A-Za-z0-9_-]{16,}+)(?![A-Za-z0-9])",
    "phone": r"(?<![\d+])\+(?=(?:[ .()-]{0,2}\d){7,15}(?!\d))\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:" + GROUP + r"){1,7}(?!\d)"
    r"|(?<![\d(])\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\d)|(?<![\d.-])\d{3}[-. ]\d{3}[-. ]\d{4}(?![\d-])"
    r"|(?<![\d.,-])0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?![\d.,-])",
    "ip": r"(?<![\d.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?!\.?\d)",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[0-9A-Fa-f:]*[0-9A-Fa-f]{3})(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])",
    "person": r"(?<!\p{L})(?:" + TITLES + r")\.?(?:" + GAP + "(?:" + TITLES + r")(?!\p{L})\.?)*+(?:" + GAP + NAME + ")+",
}
PATTERN = "|".join(KINDS.values())
# Vowels and consonants of the scripts that names are drawn in.
SCRIPTS = {
    "latin": ("aeiou", "bcdfghjklmnprstvwxyz", "a", "n", "e"),
    "cyrillic": ("аеиоу", "бвгдзклмнпрстфх", "а", "н", "е"),
    "greek": ("αειου", "βγδζθκλμνπρστφχ", "α", "ς", "ε"),
}
# Letters that stand in for those of scripts without case.
OTHERS = {
    r"\p{IsHan}": "山川田中木林森石水火土金日月天地人心手口目耳牛馬鳥魚米竹花草",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねの",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하고노도로모보소오조호",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsDevanagari}": "कखगघचछजझटठडढतथदधनपफबभमयरलवशस",
    r"\p{IsThai}": "กขคงจฉชซญดตถทธนบปผพฟมยรลวสหอ",
}
ANY = "abcdefghijklmnopqrstuvwxyz"
#: Attempts after which a surrogate grows, and after which it ends in a part of its hash, so that
#: every value has a surrogate of its own after a bounded number of attempts.
GROWING, ENDING = 3, 8
# Kinds whose form has a fixed length.
FIXED = ("ip", "card", "access_key", "ssn")


def kind_of(found: Column) -> Column:
    """The kind of a found string: the first whose whole pattern it is."""
    out = None
    for kind, pattern in KINDS.items():
        fits = found.rlike(f"^(?:{pattern})$")
        if kind == "secret":  # a value of marks only tells nothing
            fits &= F.regexp_replace(found, f"^{SECRET}", "").rlike(r"[\p{L}\p{N}]")
        if kind == "card":
            fits &= F.call_function("luhn_check", F.regexp_replace(found, "[^0-9]", ""))
        out = F.when(fits, kind) if out is None else out.when(fits, kind)
    return out


def script_of(name: Column) -> Column:
    return (
        F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(name.rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def parts_of(found: Column, kind: Column) -> Column:
    """A found string as parts (kind, raw); parts without a kind stay as they are."""

    def part(of: Column | str | None, raw: Column) -> Column:
        of = F.lit(None).cast("string") if of is None else F.lit(of) if isinstance(of, str) else of
        return F.struct(of.alias("kind"), raw.alias("raw"))

    tokens = F.regexp_extract_all(found, F.lit(r"[ \t]+|[^ \t]+"), F.lit(0))
    plain = F.transform(tokens, lambda t: F.regexp_replace(t, r"\.$", ""))

    def titled(titles):
        both = sorted({x for t in titles for x in (t, t.upper())})
        return F.arrays_overlap(F.slice(plain, 1, leading), F.array(*map(F.lit, both)))

    # Titles stand at odd places before the names.
    every = [x for t in MALE + FEMALE + OPEN for x in (t, t.upper())]
    named = F.filter(
        F.sequence(F.lit(1), F.size(tokens), F.lit(2)), lambda i: ~F.element_at(plain, i).isin(*every)
    )
    leading = F.coalesce(F.try_element_at(named, F.lit(1)) - 1, F.size(tokens))
    gender = F.when(titled(MALE), "m").when(titled(FEMALE), "f").otherwise("n")

    def of_token(token: Column, i: Column) -> Column:
        given = F.concat_ws("-", F.lit("given"), gender, script_of(token))
        name = F.when(i == F.size(tokens) - 1, F.concat(F.lit("surname-"), script_of(token))).otherwise(given)
        return part(F.when((i >= leading) & ~token.rlike(r"^[ \t]"), name), token)

    person = F.transform(tokens, of_token)
    label = F.regexp_extract(found, f"^{SECRET}[\"']?", 0)
    quote = F.when(label.rlike("[\"']$"), F.right(label, F.lit(1))).otherwise("")
    value = F.substr(found, F.length(label) + 1, F.length(found) - F.length(label) - F.length(quote))
    prefix = F.regexp_extract(found, f"^{KEY}", 0)
    head, foot = F.regexp_extract(found, f"^{BLOCK}", 0), F.regexp_extract(found, "-----END [A-Z ]*PRIVATE KEY-----$", 0)
    body = F.substr(found, F.length(head) + 1, F.length(found) - F.length(head) - F.length(foot))
    country = F.regexp_extract(found, COUNTRY, 0)
    local = F.substr(found, F.length(country) + 1)
    return (
        F.when(kind == "person", person)
        .when(kind == "secret", F.array(part(None, label), part("secret", value), part(None, quote)))
        .when(kind == "access_key", F.array(part(None, prefix), part("access_key", F.substr(found, F.length(prefix) + 1))))
        .when(kind == "private_key", F.array(part(None, head), part("private_key", body), part(None, foot)))
        .when(kind == "phone", F.array(part(None, country), part("phone", local)))
        .otherwise(F.array(part(kind, found)))
    )


def normal(kind: Column, raw: Column) -> Column:
    """The value behind a part: without case where case does not tell, without separators."""
    return (
        F.when(kind.isin("secret", "access_key", "private_key"), raw)
        .when(kind.isin("phone", "ssn", "card", "iban"), F.lower(F.regexp_replace(raw, "[^0-9A-Za-z]", "")))
        .otherwise(F.lower(raw))
    )


def _drawn(letters: str, byte: Column) -> Column:
    return F.substr(F.lit(letters), (byte % len(letters) + 1).cast("int"), F.lit(1))


def _like(char: Column, at: Column, byte: Column, hexadecimal: Column) -> Column:
    """A character of the same class, drawn by a byte."""
    low = F.lower(char)
    out = F.when(
        char.rlike("[0-9]"),
        F.when((at == 0) & (char != "0"), (byte % 9 + 1).cast("string")).otherwise(
            (byte % 10).cast("string")
        ),
    ).when(hexadecimal & low.rlike("[a-f]"), _drawn("abcdef", byte))
    for vowels, consonants, *_ in SCRIPTS.values():
        # Accented vowels of the script fall under its consonants, which does no harm.
        script = {"aeiou": r"\p{IsLatin}", "аеиоу": r"\p{IsCyrillic}"}.get(vowels, r"\p{IsGreek}")
        plain = F.when(low.rlike(f"[{vowels}]"), _drawn(vowels, byte)).otherwise(
            _drawn(consonants, byte)
        )
        out = out.when(char.rlike(script), F.when(char != low, F.upper(plain)).otherwise(plain))
    for script, letters in OTHERS.items():
        out = out.when(char.rlike(script), _drawn(letters, byte))
    out = out.when(char.rlike(r"\p{L}"), _drawn(ANY, byte))
    return out.when(char.rlike(r"\p{N}"), (byte % 10).cast("string")).otherwise(char)


def with_surrogate(values: DataFrame, key: str) -> DataFrame:
    """Values (kind, norm, attempt) with the surrogate their hash draws."""
    seed = F.concat_ws("\x1f", F.lit(key), "kind", "norm", F.col("attempt").cast("string"))
    size = F.length("norm") + 2 * F.col("attempt") + 16 + 2 * F.lit(ENDING)
    blocks = F.sequence(F.lit(0), F.floor(size / 32).cast("int"))
    stream = F.array_join(
        F.transform(blocks, lambda i: F.sha2(F.concat(seed, F.lit("\x1f"), i.cast("string")), 256)), ""
    )
    values = values.withColumn("_stream", stream)

    def byte(at: Column) -> Column:
        pair = F.substr(F.col("_stream"), (at * 2 + 1).cast("int"), F.lit(2))
        return F.conv(pair, 16, 10).cast("int")

    def shaped(text: Column) -> Column:
        hexadecimal = ((F.col("kind") == "secret") & text.rlike("^[0-9a-f]+$")) | (F.col("kind") == "ip6")
        chars = F.split(text, "(?!^)(?!$)")
        return F.array_join(
            F.transform(chars, lambda c, i: _like(c, i, byte(i), hexadecimal)), ""
        )

    kind, norm = F.col("kind"), F.col("norm")
    top = F.regexp_extract(norm, r"\.[a-z0-9-]+$", 0)
    local = F.regexp_extract(norm, "^[^@]*", 0)
    at_host = F.substr(norm, F.length(local) + 1, F.length(norm) - F.length(local) - F.length(top))
    octets = [byte(F.lit(i)) for i in range(4)]
    ip = F.concat_ws(
        ".", *[x.cast("string") for x in (octets[0] % 223 + 1, *octets[1:3], octets[3] % 254 + 1)]
    )
    body = F.concat(
        F.substr(norm, F.lit(1), F.lit(1)),
        F.substr(shaped(norm), F.lit(2), F.length(norm) - 2),
    )
    digits = F.array(*[F.lit(str(d)) for d in range(10)])
    fits = F.filter(digits, lambda d: F.call_function("luhn_check", F.concat(body, d)))
    card = F.concat(body, fits[0])
    out = (
        F.when(kind == "ip", ip)
        .when(kind == "card", card)
    )
    more = F.sequence(F.lit(0), F.greatest(F.col("attempt") - GROWING, F.lit(0)))

    def grown(vowels: str, consonants: str) -> Column:
        def syllable(i: Column) -> Column:
            at = F.length("norm") + 2 * i
            return F.concat(_drawn(consonants, byte(at)), _drawn(vowels, byte(at + 1)))

        return F.array_join(F.transform(F.filter(more, lambda i: i > 0), syllable), "")

    # Drawn over the whole, so that the parts of an address do not repeat each other.
    whole = shaped(F.concat(local, at_host))
    longer = grown(*SCRIPTS["latin"][:2])
    email = F.concat(
        F.substr(whole, F.lit(1), F.length(local)), longer, F.substr(whole, F.length(local) + 1), top
    )
    out = out.when(kind == "email", email)
    for script, (vowels, consonants, female, male, neutral) in SCRIPTS.items():
        syllables = grown(vowels, consonants)
        name = F.concat(shaped(norm), syllables)
        out = out.when(kind == f"surname-{script}", name)
        for gender, end in (("f", female), ("m", male), ("n", neutral)):
            stem = F.substr(name, F.lit(1), F.length(name) - 1)
            out = out.when(kind == f"given-{gender}-{script}", F.concat(stem, F.lit(end)))
    numbers = F.regexp_replace(F.substr(F.col("_stream"), F.lit(1), 2 * F.size(more) - 2), "[a-f]", "7")
    out = out.when(kind.isin("phone", "iban"), F.concat(shaped(norm), numbers))
    out = out.when(kind.isin(*FIXED), shaped(norm)).otherwise(F.concat(shaped(norm), longer))
    # In the end a part of the hash tells apart what the form leaves no room for.
    last = F.concat(out, F.lit("-"), F.substr(F.col("_stream"), F.lit(1), F.lit(32)))
    ended = F.when(F.col("attempt") >= ENDING, last).otherwise(out)
    return values.withColumn("surrogate", ended).drop("_stream")


def distinct_surrogates(values: DataFrame, key: str) -> DataFrame:
    """kind, norm and surrogate of every value, no surrogate twice in a kind, none a value."""
    values = staged(values, "values")
    done, waiting = None, values.withColumn("attempt", F.lit(0))
    real = values.select("kind", F.col("norm").alias("surrogate"))
    while True:
        drawn = with_surrogate(waiting, key)
        first = Window.partitionBy("kind", "surrogate").orderBy("norm")
        drawn = drawn.withColumn("_place", F.row_number().over(first))
        taken = real if done is None else real.union(done.select("kind", "surrogate"))
        clash = taken.distinct().withColumn("_clash", F.lit(True))
        judged = staged(drawn.join(clash, ["kind", "surrogate"], "left"), "drawn")
        good = (F.col("_place") == 1) & F.col("_clash").isNull()
        accepted = judged.where(good).select("kind", "norm", "surrogate")
        done = accepted if done is None else done.union(accepted)
        waiting = judged.where(~good).select("kind", "norm", F.col("attempt") + 1).toDF(
            "kind", "norm", "attempt"
        )
        if waiting.isEmpty():
            return done


def formatted(kind: Column, raw: Column, surrogate: Column) -> Column:
    """A surrogate in the case and with the separators of an occurrence."""
    skips = kind.isin("phone", "ssn", "card", "iban")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, char: Column) -> Column:
        keep = skips & ~char.rlike("[0-9A-Za-z]")
        own = F.substr(surrogate, state["at"] + 1, F.lit(1))
        cased = F.when(char != F.lower(char), F.upper(own)).otherwise(own)
        return F.struct(
            F.concat(state["out"], F.when(keep, char).otherwise(cased)).alias("out"),
            (state["at"] + F.when(keep, 0).otherwise(1)).alias("at"),
        )

    walked = F.aggregate(F.split(raw, "(?!^)(?!$)"), start, step)
    rest = F.substr(surrogate, walked["at"] + 1)
    shouted = (raw == F.upper(raw)) & (F.length(raw) > 1)
    tail = F.when(shouted & kind.rlike("name|given"), F.upper(rest)).otherwise(rest)
    return F.when(kind == "ip", surrogate).otherwise(F.concat(walked["out"], tail))


def replacements(found: DataFrame, key: str) -> DataFrame:
    """found, kind and replacement of every distinct found string that is an entity."""
    kinds = found.withColumn("kind", kind_of(F.col("found"))).where("kind IS NOT NULL")
    parts = staged(
        kinds.select(
            "found", F.col("kind").alias("whole"), F.posexplode(parts_of(F.col("found"), F.col("kind")))
        ).select("found", "whole", "pos", F.col("col.kind").alias("kind"), F.col("col.raw").alias("raw"))
        .withColumn("norm", normal(F.col("kind"), F.col("raw"))),
        "parts",
    )
    named = parts.where("kind IS NOT NULL")
    table_of = distinct_surrogates(named.select("kind", "norm").distinct(), key)
    drawn = named.join(table_of, ["kind", "norm"]).select(
        "found", "whole", "pos", formatted(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("new")
    )
    kept = parts.where("kind IS NULL").select("found", "whole", "pos", F.col("raw").alias("new"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "new")))
    joined = F.array_join(F.transform(in_order, lambda x: x["new"]), "")
    return (
        drawn.union(kept)
        .groupBy("found", F.col("whole").alias("kind"))
        .agg(joined.alias("replacement"))
    )


ROW = "_llm_row"


def is_kind(kind: str):
    return lambda x: x["kind"] == kind


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """Documents with private data replaced in ``text``, and ``entities``: how many of each kind.

    ``key`` decides the surrogates; whoever lacks it cannot tell which value one stands for.
    """
    docs = docs.drop("entities").withColumn(ROW, F.xxhash64(id_or_last(), text_of()))
    seen = staged(
        docs.select(ROW, F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))).select(
            ROW, "pos", F.col("col").alias("found")
        ),
        "found",
    )
    new = staged(replacements(seen.select("found").distinct(), key), "replacements")
    # Both sides come straight from their shuffles, so that Spark can split a common value.
    told = seen.join(new, "found", "left")
    per_row = told.groupBy(ROW).agg(
        F.array_sort(
            F.collect_set(
                F.struct("pos", F.coalesce("replacement", "found").alias("new"), "kind")
            )
        ).alias("_new")
    )
    joined = docs.join(per_row.hint("shuffle_hash"), ROW, "left")
    # The text between found strings, each followed by what stands in for the string behind it.
    gaps = F.split("text", PATTERN, -1)
    rebuilt = F.array_join(
        F.zip_with(gaps, "_new", lambda gap, x: F.concat(gap, F.coalesce(x["new"], F.lit("")))), ""
    )
    counts = F.map_from_arrays(
        F.array(*map(F.lit, KINDS)),
        F.array(
            *[
                F.coalesce(F.size(F.filter("_new", is_kind(k))), F.lit(0)) for k in KINDS
            ]
        ),
    )
    return (
        joined.withColumn("text", F.when(F.col("_new").isNull(), F.col("text")).otherwise(rebuilt))
        .withColumn("entities", F.map_filter(counts, lambda _, n: n > 0))
        .drop(ROW, "_new")
    )


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its private data, and how many entities it held."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = replace_private(docs, key="wattspan")
    total = F.aggregate(F.map_values("entities"), F.lit(0), lambda n, x: n + x)
    return found.select(
        "doc_id", total.cast("long").alias("n_entities"), F.array_join(F.map_keys("entities"), ",").alias("kinds"), "text"
    )
