"""Text functions from Column to Column, all of Spark's built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word lists of the echo and repetition rules.
GROUNDING_STOPWORDS = """about actually again also already always anything apparently because being could does doesnt doing dont even feel feels from
gonna have just kind know like maybe more mostly normal okay probably really should something still than that thats them then there thing things think
this though trying want wanted wants what when where which with would yeah""".split()
ECHO_STOPWORDS = GROUNDING_STOPWORDS + """absolutely all and are basically but can cant completely did didnt exactly for how honestly its literally
not one right the too valid was were you your""".split()
CONTENT_STOPWORDS = "a an and are as at be but for i if in is it like of on or so that the this to was what with you your".split()
REFLECTIVE_LEADS = "yeah yep exactly right totally basically thats that this it its".split()
AGREEMENT_LEADS = "yeah yep exactly right totally".split()
END_SENTINELS = ["[END]", "<END>", "__END__", "END"]


# Fixed value: Unicode's white space and the four separators.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at either end, as Unicode has it. A trim looks at the ends only; a pattern would at all blanks."""
    return F.btrim(c, F.lit(BLANKS))


def first_of(*columns: Column) -> Column:
    """The first that is neither null nor empty; '' if there is none."""
    return F.coalesce(*(F.when(c != "", c) for c in columns), F.lit(""))


def first_set(*columns: Column) -> Column:
    """The same, stripped."""
    return strip(first_of(*columns))


def is_blank(c: Column) -> Column:
    """Whether nothing but white space is in a text; it looks no further than the first other character."""
    return ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def split_words(c: Column) -> Column:
    """Words between white space; none in an empty text."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def dedupe_key(c: Column) -> Column:
    """Lower case, single spaces, no quotes, no punctuation at the end. (Patterns, as they are faster here than translate.)"""
    plain = F.regexp_replace(strip(F.lower(c)), r"(?U)[\s\x1c-\x1f]+", " ")
    return F.rtrim(F.regexp_replace(plain, "[\"'“”‘’]", ""), F.lit("?.!,;:"))


def words(c: Column) -> Column:
    """Tokenizer A: runs of two or more letters, digits and apostrophes, apostrophes then dropped."""
    found = F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9][a-z0-9']+"), F.lit(0))
    return F.filter(F.transform(found, lambda w: F.regexp_replace(w, "'", "")), lambda w: w != "")


def words_kept(c: Column) -> Column:
    """Tokenizer B: a written-out \\n is a line break; apostrophes stay."""
    return F.regexp_extract_all(F.lower(F.replace(c, F.lit("\\n"), F.lit("\n"))), F.lit("[a-z0-9']+"), F.lit(0))


def _singular(w: Column) -> Column:
    return F.when((F.length(w) > 4) & w.endswith("s"), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)


def _kept(ws: Column, stop: list[str], least: int) -> Column:
    return F.filter(F.transform(ws, _singular), lambda w: (F.length(w) >= least) & ~w.isin(stop))


def significant_tokens(c: Column) -> Column:
    """The set of longer words that say something about the topic."""
    return F.array_distinct(_kept(words(c), GROUNDING_STOPWORDS, 4))


def echo_words(c: Column) -> Column:
    """Content words in order, repeats kept."""
    return _kept(words(c), ECHO_STOPWORDS, 3)


def content_set(ws: Column) -> Column:
    """The set of content words among tokenizer B's words."""
    return F.array_distinct(F.filter(ws, lambda w: ~w.isin(CONTENT_STOPWORDS) & (F.length(w) > 2)))


def ngrams(ws: Column, n: Column | int) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    made = F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(ws, i, n), " "))
    return F.when(F.size(ws) >= n, made).otherwise(F.array().cast("array<string>"))


def share_run(a: Column, b: Column, n: Column | int) -> Column:
    """Whether some n consecutive words of a occur in b: so whether their longest common run has n words."""
    return F.arrays_overlap(ngrams(a, n), ngrams(b, n))


def longest_run(a: Column, b: Column) -> Column:
    """The longest run of consecutive words that a and b share, as (length, start): its first place in a, from 0, or -1 for none.

    Whether there is one of n words falls with n, so that n is found by bisection, each step comparing the hashes of the n-word
    runs of both (64 bits, compared within one pair of texts).
    """
    hashed = lambda ws, n: F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - n + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(ws, i, n)))
    both = lambda n: (F.size(a) >= n) & (F.size(b) >= n) & F.arrays_overlap(hashed(a, n), hashed(b, n))
    most = F.least(F.size(a), F.size(b))
    middle = lambda s: ((s["lo"] + s["hi"] + 1) / 2).cast("int")
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(most, F.lit(1)) + 1)).cast("int"))
    halve = lambda s, _: F.when(s["lo"] >= s["hi"], s).when(both(middle(s)), F.struct(middle(s).alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), (middle(s) - 1).alias("hi")))
    by_hash = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), most.alias("hi")), halve)["lo"]
    found = lambda n: F.struct(n.alias("length"), F.when(n > 0, F.array_min(F.transform(F.array_intersect(hashed(a, n), hashed(b, n)), lambda h: F.array_position(hashed(a, n), h))) - 1).otherwise(-1).cast("int").alias("start"))
    none = F.struct(F.lit(0).alias("length"), F.lit(-1).alias("start"))
    return F.coalesce(F.element_at(F.transform(F.array(by_hash), found), 1), none)


def starts_with(ws: Column, head: Column) -> Column:
    return (F.size(ws) >= F.size(head)) & (F.slice(ws, 1, F.greatest(F.size(head), F.lit(1))) == head)


def clean_content(c: Column) -> Column:
    return strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\\n"), F.lit("\n")))


def strip_fence(c: Column, pattern: str = "(?i)^```(?:json)?") -> Column:
    """Without a code fence around it; a fence at the end alone stays."""
    plain = strip(c)
    return F.when(plain.startswith("```"), strip(F.regexp_replace(F.regexp_replace(plain, rf"{pattern}\s*", ""), r"\s*```$", ""))).otherwise(plain)


def clean_answer(c: Column) -> Column:
    """Without fence; of a JSON object the first text among assistant, answer, response and chosen; without a speaker."""
    plain = strip_fence(c)
    parsed = F.try_parse_json(plain)
    pick = lambda k: F.when(F.schema_of_variant(F.try_variant_get(parsed, f"$.{k}", "variant")) == "STRING", F.try_variant_get(parsed, f"$.{k}", "string"))
    object_ = F.when(plain.startswith("{"), F.coalesce(*(pick(k) for k in ("assistant", "answer", "response", "chosen"))))
    return strip(F.regexp_replace(strip(F.coalesce(object_, plain)), r"(?i)^(assistant|poke)\s*:\s*", ""))


def split_messages(c: Column) -> Column:
    parts = F.filter(F.transform(F.split(c, "\n\n"), strip), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(strip(c)))


def estimate_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(c) / 4)).cast("long")


def is_end(c: Column) -> Column:
    return F.upper(strip(c)).isin(END_SENTINELS)


def duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm%02ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%dh%02dm", F.floor(s / 3600), F.floor(s % 3600 / 60)))


def eta(total: Column, completed: Column, done_now: Column, elapsed: Column) -> Column:
    """The time left at this run's rate, as text; 0s without a rate."""
    rate = F.greatest(F.lit(0.0), done_now / F.greatest(F.lit(0.001), elapsed))
    return duration(F.when(rate > 0, F.greatest(F.lit(0), total - completed) / rate).otherwise(0.0))


def user_label(spec: Column) -> Column:
    """`user_` and ten hex digits of the SHA-1 of a map as JSON with sorted keys and a blank after each colon and comma.
    Keys and values are plain ASCII without quotes, as in the fixed lists they are drawn from."""
    pairs = F.transform(F.array_sort(F.map_entries(spec)), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), e["value"], F.lit('"')))
    return F.concat(F.lit("user_"), F.substring(F.sha1(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")).cast("binary")), 1, 10))


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with new columns that are computed once for each row: a generator of one row keeps the optimizer from copying a
    costly expression to every place that uses it."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))
