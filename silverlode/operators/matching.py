"""Entity matching between two customer registries.

Two records are the same customer by the first rule that holds: similar name and
similar e-mail (1), similar name and equal phone (2), similar name and similar
address (3). Similar means trigram similarity of at least the threshold, of whole
e-mails without the separators of their user part, of whole addresses; both must also
share their digits, so neighbouring house numbers or numbered mailboxes do not count
as spelling variants.

Comparing every pair of records is quadratic. The plan here returns the same
matches without it:

* each rule works on the distinct (name, field) values of a registry, so copies of
  a record are compared once, with their smallest id;
* two values can only match if they belong to one group: the digits of their field, or
  their phone. Groups are counted first. Where few pairs come together, the group is the
  key under which its values meet, one row each; a crowded group adds one or two
  trigrams of the name to its keys;
* two names can only be similar if they share one of their first few trigrams in a
  fixed global order (prefix filtering: ``n - ceil(t * n) + 1`` of ``n``, one more for
  each further trigram asked for). The order puts the trigrams that the registries use
  most last, counted over both, so a frequent surname hardly ever becomes a key;
* a key row is three numbers: the key, sketches of both trigram sets with their sizes,
  and the value's number. Sketches of similar sets differ in few bits at most, so nearly
  all pairs that meet by chance go inside the join and are never written;
* the others are verified with the full similarity, so keys and sketches decide only
  which pairs are looked at, never which pairs match.

Every join here shuffles both sides. What a value's keys and trigrams take says nothing
about the size of its compressed file, which is what Spark would go by when it decides to
collect a side on the driver and broadcast it. Trigrams are made again where they are
needed and never written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import edit_similarity, email_whole, jaccard, trigrams
from ..functions.text import compact_email, digits, title
from ..session import stage
from .clean import dedupe_by_key
from .ordering import global_row_number

# Fixed value: similarity from which two texts count as the same.
THRESHOLD = 0.6
FIELDS = {1: "email", 2: "phone", 3: "endereco"}
#: Trigrams that go last in the order: the most frequent, and those after them.
MOST_FREQUENT, FREQUENT = 32, 512
#: Pairs of values from which the keys of a group take one trigram of the name, and two.
CROWDED = (1 << 20, 1 << 33)
#: Groups are dealt into this many buckets; all of a bucket take what its largest needs.
BUCKETS = 4096
#: Bits of the sketches of names and of other fields, and the size at which a set is only called large.
NAME_BITS, VALUE_BITS, LARGE = 32, 48, 255


def _shuffled(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """Join whose sides never pass through the driver, at any size."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def harmonise_split_names(df: DataFrame, source: str, prefix: str) -> DataFrame:
    """Registry with first and last name in two columns and an id of its own."""
    return df.select(
        F.lit(source).alias("source_name"),
        F.concat(F.lit(prefix), F.col("customer_id").cast("string")).alias("registro_id"),
        F.concat_ws(" ", title(F.col("first_name")), title(F.col("last_name"))).alias("full_name"),
        *_contact_columns(),
    )


def harmonise_full_names(df: DataFrame, source: str, prefix: str) -> DataFrame:
    """Registry with one name column and no id: records are numbered in name order."""
    numbered = global_row_number(df, ["nome", "email", "phone", "address"], "_n")
    return numbered.select(
        F.lit(source).alias("source_name"),
        F.concat(F.lit(prefix), F.col("_n").cast("string")).alias("registro_id"),
        title(F.col("nome")).alias("full_name"),
        *_contact_columns(),
    )


def _contact_columns() -> list[Column]:
    return [
        compact_email(F.col("email")).alias("email"),
        digits(F.col("phone")).alias("phone"),
        F.lower(F.trim("address")).alias("endereco"),
    ]


def _tokens(name: str, email: str | None = None, address: str | None = None) -> dict[str, Column]:
    """Trigram sets and guards of the given columns, to be computed once per row."""
    out = {f"_t_{name}": trigrams(F.lower(name))}
    if email:
        out[f"_t_{email}"] = trigrams(email_whole(F.col(email)))
        out[f"_g_{email}"] = digits(F.col(email))
    if address:
        out[f"_t_{address}"] = trigrams(F.col(address))
        out[f"_g_{address}"] = digits(F.col(address))
    return out


def _guarded(a: str, b: str) -> Column:
    """Similarity of two token sets whose guards agree, 0 otherwise."""
    alike = jaccard(F.col(f"_t_{a}"), F.col(f"_t_{b}"))
    return F.coalesce(F.when(F.col(f"_g_{a}") == F.col(f"_g_{b}"), alike), F.lit(0.0))


def _once(*cols: Column) -> Column:
    """These columns, computed once a row: a filter on them stays behind and does not compute them itself."""
    return F.inline(F.array(F.struct(*cols)))


def frequent_tokens(left: DataFrame, right: DataFrame, tokens: Column) -> list[str]:
    """At most ``FREQUENT`` tokens of two tables of values, the most frequent first."""
    used = left.select(F.explode(tokens).alias("t")).unionByName(right.select(F.explode(tokens).alias("t")))
    top = used.groupBy("t").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "t").limit(FREQUENT)
    return [r["t"] for r in top.collect()]


def _at_least(n: Column, share: float) -> Column:
    """Least whole number that is this share of ``n``."""
    return F.ceil(n * F.lit(share) - 1e-9).cast("int")


def _ordered(tokens: str, frequent: list[str]) -> Column:
    """Hashes of a token set in the global order. Any fixed order is correct; rare tokens first makes selective keys."""

    def late(t: Column) -> Column:
        tier = F.when(t.isin(frequent[:MOST_FREQUENT]), 2) if frequent else F.when(F.lit(False), 2)
        common = t.startswith(" ") | t.isin(frequent) if frequent else t.startswith(" ")
        return tier.when(common, 1).otherwise(0).cast("bigint") * F.lit(1 << 61)

    return F.array_sort(F.transform(tokens, lambda t: F.shiftrightunsigned(F.xxhash64(t), 3) + late(t)))


def _sketch(tokens: str, bits: int) -> Column:
    """Number of ``bits`` bits, each the parity of the tokens hashed to it: two sets differ in as many tokens at least."""

    def flipped(sketch: Column, t: Column) -> Column:
        place = F.pmod(F.xxhash64(t), F.lit(bits)).cast("int")
        return sketch.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))

    return F.aggregate(tokens, F.lit(0).cast("bigint"), flipped)


def _size(tokens: str) -> Column:
    return F.least(F.size(tokens), F.lit(LARGE)).cast("bigint")


def _values(registry: DataFrame, rule: int) -> DataFrame:
    """Distinct (name, field) values with smallest id and row count."""
    return (
        registry.select("registro_id", "full_name", F.col(FIELDS[rule]).alias("valor"))
        .where(F.col("full_name").isNotNull() & F.col("valor").isNotNull())
        .groupBy("full_name", "valor")
        .agg(F.min("registro_id").alias("id"), F.count(F.lit(1)).alias("registros"))
        .where(F.col("id").isNotNull())
    )


def _value_tokens(rule: int, side: str = "") -> dict[str, Column]:
    """Trigram sets of a value, and the guard of its field."""
    name, value = f"full_name{side}", f"valor{side}"
    if rule == 1:
        return _tokens(name, email=value)
    return _tokens(name) if rule == 2 else _tokens(name, address=value)


def _group(rule: int) -> Column:
    """What two values must have in common exactly, as a number."""
    return F.xxhash64(F.col("valor") if rule == 2 else digits(F.col("valor")))


def _bucket(group: Column) -> Column:
    return F.pmod(group, F.lit(BUCKETS)).cast("int")


def _crowded(left: DataFrame, right: DataFrame, rule: int) -> list[list[int]]:
    """For each step of ``CROWDED``, the buckets that hold a group of more pairs."""

    def counted(df: DataFrame, n: str) -> DataFrame:
        return df.groupBy(_group(rule).alias("_g")).agg(F.count(F.lit(1)).cast("double").alias(n))

    pairs = _shuffled(counted(left, "_a"), counted(right, "_b"), "_g").select(_bucket(F.col("_g")).alias("_in"), (F.col("_a") * F.col("_b")).alias("_pairs"))
    most = pairs.groupBy("_in").agg(F.max("_pairs").alias("_most")).where(F.col("_most") > CROWDED[0]).collect()
    return [sorted(r["_in"] for r in most if r["_most"] > step) for step in CROWDED]


def _keys(values: DataFrame, rule: int, threshold: float, names: list[str], crowded: list[list[int]]) -> DataFrame:
    """Rows under which values of two registries have to meet.

    ``_key`` has the hash of the group and of no, one or two trigrams of the name in its
    upper half and the sketch of the name in its lower, ``_field`` the sketch of the field
    and the sizes of both sets, ``_n`` the value's number.
    """
    tokens = _value_tokens(rule)
    name, value = "_t_full_name", "_t_valor"
    whole = {1: email_whole(F.col("valor")), 3: F.col("valor")}
    named = values.where(F.length("full_name") > 0)  # an empty text has no trigrams and is like nothing
    sets = (named.where(F.length(whole[rule]) > 0) if rule in whole else named).select("_n", _group(rule).alias("_g"), "full_name", "valor").withColumns(tokens)
    field = F.lit(0).cast("bigint")
    if rule in whole:
        field = F.shiftleft(_sketch(value, VALUE_BITS), 16).bitwiseOR(_size(value))
    pieces = F.lit(0)
    for step in crowded:
        pieces = pieces + _bucket(F.col("_g")).isin(step).cast("int") if step else pieces
    rows = sets.select(
        "_n", "_g",
        pieces.alias("_pieces"), _ordered(name, names).alias("_o"),
        F.size(name).alias("_size"), _at_least(F.size(name), threshold).alias("_least"),
        _sketch(name, NAME_BITS).alias("_name"),
        field.bitwiseOR(F.shiftleft(_size(name), 8)).alias("_field"),
    )
    kept, none = ["_n", "_g", "_name", "_field"], F.array(F.lit(0).cast("bigint"))
    prefix = F.slice("_o", 1, F.least(F.col("_size"), F.col("_size") - F.col("_least") + F.col("_pieces")))
    first = rows.withColumn("_p", F.when(F.col("_pieces") == 0, none).otherwise(prefix)).select(
        *kept, "_pieces", "_least", "_p", F.posexplode("_p").alias("_i", "_a")
    )
    later = F.slice("_p", F.col("_i") + 2, F.size("_p"))
    # sets of which similar ones may share a single trigram only also have that alone as a key
    second = F.when(F.col("_pieces") < 2, none).when(F.col("_least") < 2, F.concat(later, none)).otherwise(later)
    both = first.select(*kept, "_a", F.explode(second).alias("_b"))
    key = F.shiftleft(F.hash("_g", "_a", "_b").cast("bigint"), NAME_BITS).bitwiseOR(F.col("_name"))
    return both.select(key.alias("_key"), "_field", "_n")


def _within(differing: Column, size_a: Column, size_b: Column, threshold: float) -> Column:
    """Whether sketches of two sets differ in no more bits than similar sets of these sizes can."""
    both = size_a + size_b
    most = both - 2 * _at_least(both, threshold / (1 + threshold))
    return (size_a == LARGE) | (size_b == LARGE) | (F.bit_count(differing) <= most)


def candidates(left: DataFrame, right: DataFrame, rule: int, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct numbers (_n_a, _n_b) of values that share a key and whose sketches are close."""
    names = frequent_tokens(left, right, trigrams(F.lower("full_name")))
    crowded = _crowded(left, right, rule)
    a, b = (_keys(v, rule, threshold, names, crowded).toDF(*[f"{c}_{s}" for c in ("_key", "_field", "_n")]) for v, s in ((left, "a"), (right, "b")))

    def size(s: str, at: int) -> Column:
        return F.shiftright(f"_field_{s}", at).bitwiseAND(F.lit(LARGE))

    name = F.col("_key_a").bitwiseXOR(F.col("_key_b")).bitwiseAND(F.lit((1 << NAME_BITS) - 1))
    field = F.shiftrightunsigned(F.col("_field_a").bitwiseXOR(F.col("_field_b")), 16)
    meet = F.shiftright("_key_a", NAME_BITS) == F.shiftright("_key_b", NAME_BITS)
    meet = meet & _within(name, size("a", 8), size("b", 8), threshold)
    if rule != 2:
        meet = meet & _within(field, size("a", 0), size("b", 0), threshold)
    return _shuffled(a, b, meet).select("_n_a", "_n_b").distinct()


def _verified(a: DataFrame, b: DataFrame, rule: int, threshold: float) -> DataFrame:
    """Pairs of distinct values that match under one rule, with the number of the second."""
    # written once with their numbers: counting, making keys and verifying read them
    left, right = (stage(_values(r, rule).withColumn("_n", F.monotonically_increasing_id()), f"values_{rule}") for r in (a, b))

    def side(df: DataFrame, s: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}_{s}") for c in df.columns])

    met = candidates(left, right, rule, threshold)
    paired = _shuffled(_shuffled(met, side(left, "a"), "_n_a"), side(right, "b"), "_n_b")
    tokens = _value_tokens(rule, "_a") | _value_tokens(rule, "_b")
    if rule == 2:
        alike = F.when(F.col("valor_a") == F.col("valor_b"), 1.0).otherwise(0.0)
    else:
        alike = _guarded("valor_a", "valor_b")
    scored = paired.withColumns(tokens).select(
        *[f"{c}_{s}" for s in "ab" for c in ("id", "full_name", "valor", "registros")],
        _once(jaccard(F.col("_t_full_name_a"), F.col("_t_full_name_b")).alias("sim_nome"), alike.alias("sim_valor")),
        F.lit(rule).alias("regra"),
        "_n_b",
    )
    return scored.where((F.col("sim_nome") >= threshold) & (F.col("sim_valor") >= threshold))


def matching_values(a: DataFrame, b: DataFrame, rule: int, threshold: float = THRESHOLD) -> DataFrame:
    """Verified pairs of distinct values of two registries under one rule."""
    return _verified(a, b, rule, threshold).drop("_n_b")


def best_values(a: DataFrame, b: DataFrame, rule: int, threshold: float = THRESHOLD) -> DataFrame:
    """Best partner of each value of ``b`` under one rule: highest name similarity, then smallest id."""
    pick = F.min(F.struct((-F.col("sim_nome")).alias("far"), F.col("id_a").alias("id"))).alias("_best")
    return (
        _verified(a, b, rule, threshold)
        .groupBy("_n_b", "full_name_b", "valor_b")
        .agg(pick)
        .select(F.col("full_name_b").alias("full_name"), F.col("valor_b").alias("valor"), F.col("_best.id").alias("id_a"))
    )


def signals(a: DataFrame, b: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Each record of ``b`` with its best partner per rule and every similarity signal.

    At most three rows per record, however many copies either registry holds; a record
    without any partner has one row, whose partner columns are NULL.
    """
    found = None
    for rule, field in FIELDS.items():
        best = best_values(a, b, rule, threshold).withColumnRenamed("valor", field)
        rows = _shuffled(b, best, ["full_name", field]).select(F.col("registro_id").alias("_js"), "id_a")
        found = rows if found is None else found.unionByName(rows)

    def side(df: DataFrame, s: str) -> DataFrame:
        names = {"source_name": "source", "registro_id": "id", "full_name": "nome", "email": "email", "phone": "phone", "endereco": "endereco"}
        return df.select(*[F.col(c).alias(f"{n}_{s}") for c, n in names.items()])

    linked = _shuffled(side(b, "js"), found.distinct(), F.col("id_js") == F.col("_js"), "left")
    pairs = _shuffled(linked, side(a, "pg"), F.col("id_a") == F.col("id_pg"), "left").drop("id_a", "_js")
    tokens = {k: v for s in ("js", "pg") for k, v in _tokens(f"nome_{s}", f"email_{s}", f"endereco_{s}").items()}
    sims = pairs.withColumns(tokens).select(
        *pairs.columns,
        _once(
            jaccard(F.col("_t_nome_pg"), F.col("_t_nome_js")).alias("sim_nome"),
            edit_similarity(F.lower("nome_pg"), F.lower("nome_js")).alias("sim_edicao_nome"),
            _guarded("email_pg", "email_js").alias("sim_email"),
            _guarded("endereco_pg", "endereco_js").alias("sim_endereco"),
        ),
        F.coalesce(F.col("phone_pg") == F.col("phone_js"), F.lit(False)).alias("telefone_igual"),
    )
    return sims.select(
        "*",
        (F.col("sim_nome") >= threshold).alias("nome_ok"),
        (F.col("sim_email") >= threshold).alias("email_ok"),
        (F.col("sim_endereco") >= threshold).alias("endereco_ok"),
    )


def cascade(signal_rows: DataFrame) -> DataFrame:
    """Number of the first rule that holds, NULL if none does."""
    name = F.col("nome_ok")
    rule = (
        F.when(name & F.col("email_ok"), 1)
        .when(name & F.col("telefone_igual"), 2)
        .when(name & F.col("endereco_ok"), 3)
    )
    return signal_rows.withColumn("regra_match", rule)


def best_match(cascaded: DataFrame) -> DataFrame:
    """One partner per record: smallest rule, then highest name similarity, then smallest id."""
    return dedupe_by_key(
        cascaded.where(F.col("regra_match").isNotNull()),
        ["id_js"],
        [F.col("regra_match"), -F.col("sim_nome"), F.col("id_pg")],
    )
