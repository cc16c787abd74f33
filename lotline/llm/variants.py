"""Spelling variants of the words of a corpus, by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Two words one edit apart have reduced words that are equal or one edit
apart, so the full one-edit neighbourhood of every reduced word is generated and joined with the reduced
vocabulary by equality; the pairs found are verified on the original strings. The neighbourhood of a word over
90 letters has thousands of members, over a few symbols some dozens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.staging import stage, stage_observed

# fixed values: what a run of letters is, and the shortest word and least count that take part
LETTERS = "[A-Za-zÀ-ÿ]"
MIN_LENGTH = 6
MIN_COUNT = 5
# one run in so many loses a letter, by crc32 of id and run
DAMAGE = 199
# how much more frequent a form must be than its variant
RATIO = 5
# symbols that letters are hashed to: more symbols, fewer false pairs and larger neighbourhoods
SYMBOLS = 12
_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))


def _reduced(word: Column, symbols: int) -> Column:
    """The word with every letter replaced by the symbol (a, b, c ...) that its code point is hashed to.

    Code points go round the symbols in strides of 7, so neighbours in the alphabet and the vowels are apart.
    """
    known = [*range(97, 123), *range(0xC0, 0x100)]
    return F.translate(word, "".join(map(chr, known)), "".join(chr(97 + (c * 7 + c // 16) % symbols) for c in known))


def one_edit_neighbourhood(word: Column, symbols: int) -> Column:
    """The word itself and all strings one deletion, replacement or insertion away over the symbols, each once."""
    alphabet = F.array(*[F.lit(chr(97 + s)) for s in range(symbols)])
    size = F.length(word)
    head = lambda i: F.substring(word, F.lit(1), i)  # noqa: E731  the first i letters
    tail = lambda i: F.substring(word, i + 1, size)  # noqa: E731  all after the first i
    places, gaps = F.sequence(F.lit(0), size - 1), F.sequence(F.lit(0), size)
    deleted = F.transform(places, lambda i: F.concat(head(i), tail(i + 1)))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(alphabet, lambda s: F.concat(head(i), s, tail(i + 1)))))
    inserted = F.flatten(F.transform(gaps, lambda i: F.transform(alphabet, lambda s: F.concat(head(i), s, tail(i)))))
    return F.array_distinct(F.concat(F.array(word), deleted, replaced, inserted))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n): maximal runs of letters with A-Z in lower case, some of them damaged, that are long and frequent enough.

    With h the crc32 of "id:run", a run whose h is divisible by `damage` loses its letter number h modulo its
    length. Every occurrence in every row counts, also of repeated rows; null texts have no words, a null id is
    written as nothing. Occurrences are summed before the shuffle, so a frequent word is one row per task.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(LETTERS + "{%d,}" % min_length), F.lit(0))
    found = docs.select(
        F.coalesce(docs[doc_id].cast("string"), F.lit("")).alias("id"), docs[text].cast("string").alias("text")
    ).select("id", F.explode(runs).alias("run"))
    run = F.translate("run", _UPPER, _LOWER)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = found.select("id", run.alias("run")).select("run", h.alias("h")).select(
        F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word")
    )
    counted = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(a, b), a and b words of the table `word` that are exactly one inserted, deleted or replaced letter apart, each pair once.

    A reduced word lies in the neighbourhood of another exactly if the reverse holds, so of every neighbourhood
    the members that sort (by length, then as strings) up to the word itself decide all pairs. Reduced words are compared
    once however many words share them; the words behind a pair of reduced words are verified in the same task.
    """
    reduced = words.select("word", _reduced(F.col("word"), symbols).alias("reduced"))
    forms = reduced.select("reduced").distinct()
    size = F.length("reduced")
    first = F.filter(one_edit_neighbourhood(F.col("reduced"), symbols), lambda k: (F.length(k) < size) | ((F.length(k) == size) & (k <= F.col("reduced"))))
    keys = forms.select(F.col("reduced").alias("from"), F.explode(first).alias("key"))
    pairs = keys.join(forms.select(F.col("reduced").alias("key")), "key")
    left = reduced.select(F.col("word").alias("a"), F.col("reduced").alias("from"))
    right = reduced.select(F.col("word").alias("b"), F.col("reduced").alias("key"))
    both = pairs.join(left, "from").join(right, "key")
    # words of one reduced word meet in both orders
    once = (F.col("from") != F.col("key")) | (F.col("a") < F.col("b"))
    return both.where(once & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain word, form, form of the form ...; pointers are doubled until none moves.

    Counts grow by a factor along a chain, so there are no circles and a handful of rounds is enough.
    """
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        staged, seen = stage_observed(moved, "roots", {"moved": F.sum(F.col("moved").cast("int"))})
        now = staged.select("word", "root")
        if not seen["moved"]:
            return now


def group_variants(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of the table (word, n), whose words are distinct.

    n_near counts the words one edit away. form is the most frequent of them (ties: the smallest string) if it
    occurs at least `ratio` times as often, else null; root is the last word reached from form to form, the word
    itself if it has none. An empty table gives an empty result.
    """
    words = stage(words.select("word", "n"), "words")
    pairs = stage(near_pairs(words, symbols), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = near.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b"))).alias("best")
    )
    holds = -F.col("best.less") >= ratio * F.col("n")
    table = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(holds, F.col("best.b")).alias("form"), F.when(holds, -F.col("best.less")).alias("form_n"),
    )
    table = stage(table, "variants")
    roots = _roots(table.where("form is not null"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def contract_sql() -> str:
    """The same in DuckDB SQL: crc32 bit by bit, every pair of words compared after letters beyond ASCII became one byte each."""
    beyond = "".join(map(chr, range(0xC0, 0x100)))
    one_byte = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c not in "'")[: len(beyond)]
    bits = "list_reduce(range(8), lambda r, _: xor(r >> 1, 3988292384 * (r & 1)), xor(c, b))"
    return f"""
with recursive runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '{LETTERS}{{{MIN_LENGTH},}}')), '{_UPPER}', '{_LOWER}') as run from documents
), counted as (select doc_id, run, count(*) as n from runs group by 1, 2
), coded as (select *, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as h from counted
), bytes as (select *, list_transform(range(1, len(h), 2), lambda i: cast('0x' || substr(h, i, 2) as bigint)) as b from coded
), hashed as (select run, n, xor(list_reduce(b, lambda c, b: {bits}, 4294967295::bigint), 4294967295::bigint) as h from bytes
), words as (
  select case when h % {DAMAGE} = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(n)::bigint as n
  from hashed group by 1 having length(word) >= {MIN_LENGTH} and sum(n) >= {MIN_COUNT}
), plain as (select word, n, length(word) as size, translate(word, '{beyond}', '{one_byte}') as w from words
), near as (
  select a.word, b.word as other, b.n as other_n from plain a join plain b
  on b.size between a.size - 1 and a.size + 1 and a.word <> b.word and levenshtein(a.w, b.w) = 1
), best as (select word, count(*) as n_near, max(other_n) as top from near group by 1
), formed as (
  select words.word, words.n, coalesce(n_near, 0)::bigint as n_near, case when top >= {RATIO} * words.n then top end as form_n,
    (select min(other) from near where near.word = words.word and other_n = top and top >= {RATIO} * words.n) as form
  from words left join best using (word)
), chain as (
  select word, word as root, form as next from formed
  union all select chain.word, chain.next, formed.form from chain join formed on formed.word = chain.next
)
select word, form, root, n, n_near, form_n from formed join (select word, root from chain where next is null) using (word)"""
