"""Secret scans with a randomness test battery, in DataFrame and SQL functions only.

Base spans come from three patterns (assigned values, access keys, hex runs).
The method adds spans of kind "random": tokens of 20 or more base64 characters
that overlap no base span and pass two questions.

* Randomness battery, for the inferred encoding (hex, base32, base36, base64 or
  letters): a chi-squared test of uniformity over eight equal parts of the
  alphabet and over character classes, a runs test about the alphabet's middle,
  and the lag-one serial correlation, with letter case and without it; their p-values are combined by Fisher's
  rule.  A token that the battery refutes as random is dropped.
* Evidence against ordinary text, the best of five (five times the least p-value).
  Three are the battery's statistics turned round, each under the null that the
  token is ordinary text of its encoding and length: chi-squared over eight parts of
  the alphabet (ordinary text is uneven, so its statistic is large), the changes
  between the alphabet's halves (runs), and the product of neighbours (serial
  correlation).  Their null means and variances follow from the corpus's own pairs.
  The fourth is the number of changes of character class (lower, upper, digit, other)
  under a null of SWITCH changes a place.  The fifth is the likelihood of the token
  under the character pairs of ordinary text over its likelihood as a random token of
  its encoding, a p-value by Markov's inequality.
  Pairs are counted, letter case aside, over all runs of the corpus that
  are too short to be tokens, each run by the root of its number, so that a few
  frequent words do not stand for all text.  Refuted tokens count with a p-value of 1.  Over all
  tokens of the corpus the false discovery rate is held at RATE by Benjamini and
  Hochberg's rule, separately for each stratum of length, as short tokens give
  weak evidence and are many.

The p-values enter the rule as a histogram (strata x bins, of fixed size), so the
thresholds need no global sort.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import cut

# The three base patterns.  \x27 is the single quote.
ASSIGN = (r'(?i:password|passwd|secret|token|api_?key)["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)')
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# Runs shorter than the limit fail whole and hold no match of their own, so the
# limit may stand in the pattern for these two.
ACCESS_SCAN, HEX_SCAN = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
TOKEN_SCAN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
LEAST_ASSIGNED = 6

SWITCH = 0.1                # changes of class a place in ordinary tokens
RATE = 0.01                 # false discovery rate
REFUTED = 0.001             # combined p-value below which a token is not random
STRATA = (20, 24, 32, 48, 64)
BIN, BINS = 0.1, 400        # bins of -log10 p
PAIR_RUN = r"[^a-z0-9+/_-]+"    # what parts the runs whose pairs are counted

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
DIGITS = "0123456789"
FOLDED = f"{LOWER}{DIGITS}+/_-"
# Encodings with the case aside, by the weight of each symbol in a random token.
ENCODINGS = {"hex": {c: 1 for c in DIGITS + "abcdef"}, "letters": {c: 1 for c in LOWER},
             "base32": {c: 1 for c in LOWER + "234567"}, "base36": {c: 1 for c in LOWER + DIGITS},
             "base64": {c: 2 if c in LOWER else 1 for c in FOLDED}}


def _spans(pattern: str) -> str:
    """SQL: array of (s, e, m) of the matches, in code points, end exclusive.

    split() gives the pieces between the matches that regexp_extract_all() gives,
    so the running length of both is the place of each match.
    """
    p = f"r'{pattern}'"
    kind = "struct<s:int,e:int,m:string>"
    new = "named_struct('s', a.at + x.p, 'e', a.at + x.p + char_length(x.m), 'm', x.m)"
    return (f"CASE WHEN text RLIKE {p} THEN aggregate("
            f"zip_with(split(text, {p}, -1), regexp_extract_all(text, {p}, 0), "
            f"(p, m) -> named_struct('p', char_length(p), 'm', m)), "
            f"named_struct('at', 0, {_EMPTY.format(kind=kind)}), "
            f"(a, x) -> IF(x.m IS NULL, a, named_struct('at', a.at + x.p + char_length(x.m), {_added(new)})), "
            f"a -> flatten(concat(a.out, array(a.cur)))) ELSE CAST(array() AS array<{kind}>) END")


# A list that grows inside an aggregate: it is copied at each step, so it is kept in
# blocks of BLOCK and put together once.
BLOCK = 256
_EMPTY = "'cur', CAST(array() AS array<{kind}>), 'out', CAST(array() AS array<array<{kind}>>)"


def _added(new: str) -> str:
    """SQL: the two list fields of the state `a` with one entry more."""
    return (f"'cur', IF(size(a.cur) >= {BLOCK}, array({new}), concat(a.cur, array({new}))), "
            f"'out', IF(size(a.cur) >= {BLOCK}, concat(a.out, array(a.cur)), a.out)")


def _apart() -> str:
    """SQL: the tokens that overlap no base span, in one walk over both in order.

    Tokens are apart from each other, so only the last one may reach past the start
    of a base span; it is held back until the next event is known to be behind it."""
    kind = "struct<s:int,e:int,m:string>"
    events = ("array_sort(concat(transform(base, x -> named_struct('s', x.s, 'k', 0, 'e', x.e, 'm', CAST(NULL AS string))), "
              "transform(token, x -> named_struct('s', x.s, 'k', 1, 'e', x.e, 'm', x.m))))")
    kept = "IF(a.held.m IS NULL, named_struct('cur', a.cur, 'out', a.out), named_struct(" + _added("a.held") + "))"
    none = f"CAST(named_struct('s', 0, 'e', 0, 'm', NULL) AS {kind})"
    return (f"aggregate({events}, named_struct('upto', 0, 'held', {none}, {_EMPTY.format(kind=kind)}), (a, x) -> "
            f"IF(x.k = 0, named_struct('upto', greatest(a.upto, x.e), 'held', IF(a.held.e > x.s, {none}, a.held), "
            f"'cur', a.cur, 'out', a.out), "
            f"named_struct('upto', a.upto, 'held', IF(a.upto > x.s, {none}, named_struct('s', x.s, 'e', x.e, 'm', x.m)), "
            f"'cur', {kept}.cur, 'out', {kept}.out)), "
            f"a -> flatten(concat({kept}.out, array({kept}.cur))))")


def _upper_tail(z: str) -> str:
    """SQL: P(Z > z) of the standard normal, by a logistic curve (error below 2e-4)."""
    return f"(1 / (1 + exp(least(600.0, 1.5976 * ({z}) + 0.07056 * pow({z}, 3)))))"


def _chi2_tail(x: str, df: int) -> str:
    """SQL: P(X > x), chi-squared with df degrees, by the cube-root rule."""
    k = 2 / (9 * df)
    return _upper_tail(f"((pow(({x}) / {df}.0, 1.0 / 3) - {1 - k}) / {k ** 0.5})")


def _pairs(src: DataFrame) -> dict[str, int]:
    """Weighted counts of neighbouring symbols in the runs of all texts that are shorter than
    a token (at most 1,600 rows reach the driver)."""
    runs = src.select(F.explode(F.expr(f"split(lower(text), r'{PAIR_RUN}')")).alias("w"))
    runs = runs.where(f"char_length(w) BETWEEN 2 AND {min(STRATA) - 1}")
    runs = runs.groupBy("w").agg(F.expr("CAST(floor(sqrt(count(1))) AS long)").alias("m"))
    spots = runs.select("w", "m", F.explode(F.expr("sequence(1, char_length(w) - 1)")).alias("i"))
    return {r.p: r.n for r in spots.groupBy(F.expr("substr(w, i, 2)").alias("p")).agg(F.sum("m").alias("n")).collect()}


def _log_ratios(pairs: dict[str, int]) -> list[float]:
    """ln(ordinary / random) of each symbol after each, encoding by encoding; after
    them, each encoding's first symbols.

    Within an encoding the counts are smoothed by one pseudo-count a symbol, spread
    as in a random token, so without counts nothing speaks against ordinary text."""
    steps, starts = [], []
    for weights in ENCODINGS.values():
        whole = sum(weights.values())

        def row(count, weights=weights, whole=whole):
            total = sum(count(c) for c in weights)
            return [log((count(c) + len(weights) * w / whole) / (total + len(weights)) * whole / w) if (w := weights.get(c)) else 0.0
                    for c in FOLDED]

        for a in FOLDED:
            steps += row(lambda c, a=a: pairs.get(a + c, 0))
        starts += row(lambda c: sum(pairs.get(c + x, 0) for x in FOLDED))
    return steps + starts


# Numbers of an encoding under the null of ordinary text, after its three lists.
MOMENTS = ("chi_mean", "chi_mean_n", "chi_var", "chi_var_n", "turn_random", "turn", "product", "product_var")


def _ordinary(pairs: dict[str, int]) -> list[float]:
    """For each encoding: of every folded symbol its part (0 to 7), its half (0 or 1)
    and its value, standardised for a random token; then MOMENTS.

    Ordinary text is a chain of the corpus's pairs, smoothed like in `_log_ratios`."""
    out: list[float] = []
    for weights in ENCODINGS.values():
        symbols = [c for c in FOLDED if c in weights]
        whole = sum(weights.values())
        r = [weights[c] / whole for c in symbols]
        middle = [sum(r[:k]) + r[k] / 2 for k in range(len(r))]
        part = [min(7, int(8 * m)) for m in middle]
        half = [int(m >= 0.5) for m in middle]
        mean = sum(x * m for x, m in zip(r, middle))
        sd = sum(x * (m - mean) ** 2 for x, m in zip(r, middle)) ** 0.5
        value = [(m - mean) / sd for m in middle]
        chain = []
        for a in symbols:
            total = sum(pairs.get(a + c, 0) for c in symbols) + len(symbols)
            chain.append([(pairs.get(a + c, 0) + len(symbols) * x) / total for c, x in zip(symbols, r)])
        starts = [sum(pairs.get(c + x, 0) for x in FOLDED) + len(symbols) * x for c, x in zip(symbols, r)]
        q = [x / sum(starts) for x in starts]
        big_r, big_q = ([sum(x for x, y in zip(v, part) if y == j) for j in range(8)] for v in (r, q))
        both = [(x, y) for x, y in zip(big_r, big_q) if x > 0]
        slope = sum((y - x) * y / x for x, y in both)
        pull = [(q[a] * p, a, b) for a, row in enumerate(chain) for b, p in enumerate(row)]
        product = sum(w * value[a] * value[b] for w, a, b in pull)
        moments = [sum(y * (1 - y) / x for x, y in both), sum((y - x) ** 2 / x for x, y in both), 14.0,
                   # A chain's counts vary more than independent ones: twice their variance.
                   2 * 4 * max(0.0, sum((y - x) ** 2 * y / x ** 2 for x, y in both) - slope ** 2),
                   2 * sum(x for x, h in zip(r, half) if h) * sum(x for x, h in zip(r, half) if not h),
                   sum(w for w, a, b in pull if half[a] != half[b]), product,
                   max(1e-9, sum(w * (value[a] * value[b]) ** 2 for w, a, b in pull) - product ** 2)]
        of = {c: k for k, c in enumerate(symbols)}
        out += [float(v[of[c]]) if c in of else 0.0 for v in (part, half, value) for c in FOLDED] + moments
        out += [big_r[j] for j in range(8)]
    return out


def _turned_round() -> list[str]:
    """SQL: p-values of chi-squared, runs and serial correlation against ordinary text."""
    size, width = len(FOLDED), 3 * len(FOLDED) + len(MOMENTS) + 8

    def at(place: str) -> str:
        return f"get(ordinary, enc * {width} + {place})"

    m = {name: at(str(3 * size + k)) for k, name in enumerate(MOMENTS)}
    share = at(f"{3 * size + len(MOMENTS)} + j")
    chi = (f"aggregate(sequence(0, 7), 0D, (a, j) -> a + IF({share} > 0, pow(size(filter(f, y -> {at('y')} = j)) - n * {share}, 2) "
           f"/ (n * greatest({share}, 1e-9)), 0D))")
    turns = f"size(filter(sequence(1, CAST(n AS int) - 1), i -> {at(f'{size} + f[i]')} <> {at(f'{size} + f[i - 1]')}))"
    product = (f"aggregate(sequence(1, CAST(n AS int) - 1), 0D, (a, i) -> a + {at(f'{2 * size} + f[i]')} * "
               f"{at(f'{2 * size} + f[i - 1]')}) / (n - 1)")
    low = f"(({m['chi_mean']} + n * {m['chi_mean_n']} - {chi}) / sqrt({m['chi_var']} + n * {m['chi_var_n']}))"
    side = f"IF({m['turn_random']} >= {m['turn']}, 1D, -1D)"
    often = (f"({side} * ({turns} - (n - 1) * {m['turn']}) - 0.5) / sqrt(greatest(1e-9, (n - 1) * {m['turn']} * (1 - {m['turn']})))")
    near = f"(IF({m['product']} >= 0, 1D, -1D) * ({m['product']} - {product}) / sqrt({m['product_var']} / (n - 1)))"
    return [_upper_tail(z) for z in (low, f"({often})", near)]


def _battery(tokens: DataFrame, ratios: list[float], ordinary: list[float]) -> DataFrame:
    """Adds refuted (combined p-value of the battery) and p0 (against ordinary text)
    to rows with a token m."""
    body = F.regexp_replace("m", "=+$", "")
    t = tokens.withColumn("b", body).withColumn("n", F.char_length("b").cast("double"))
    t = t.withColumn("alphabet", F.expr(
        f"CASE WHEN b RLIKE '^[0-9a-f]+$' THEN '{DIGITS}abcdef' WHEN b RLIKE '^[0-9A-F]+$' THEN '{DIGITS}ABCDEF' "
        f"WHEN b RLIKE '^[a-z]+$' THEN '{LOWER}' WHEN b RLIKE '^[A-Z]+$' THEN '{UPPER}' "
        f"WHEN b RLIKE '^[A-Z2-7]+$' THEN '{UPPER}234567' "
        f"WHEN b RLIKE '^[a-z0-9]+$' THEN '{DIGITS}{LOWER}' WHEN b RLIKE '^[A-Z0-9]+$' THEN '{DIGITS}{UPPER}' "
        f"ELSE '{UPPER}{LOWER}{DIGITS}+/_-' END"))
    t = t.withColumn("k", F.expr("IF(char_length(alphabet) > 64, 64, char_length(alphabet))"))
    # Cut into characters once: a substr of place i walks over i characters.
    t = t.withColumn("ch", F.expr("split(b, '')"))
    t = t.withColumn("v", F.expr("transform(ch, x -> least(k - 1, instr(alphabet, x) - 1))"))
    t = t.withColumn("c", F.expr("transform(ch, x -> CASE WHEN x BETWEEN '0' AND '9' THEN 0 "
                                 "WHEN x BETWEEN 'a' AND 'z' THEN 1 WHEN x BETWEEN 'A' AND 'Z' THEN 2 ELSE 3 END)"))
    t = t.withColumn("f", F.expr(f"transform(ch, x -> instr('{FOLDED}', lower(x)) - 1)"))
    # Uniformity over eight equal parts of the alphabet, and over its classes.
    t = t.withColumn("x8", F.expr("aggregate(sequence(0, 7), 0D, (a, j) -> a + pow(size(filter(v, y -> CAST(floor(y * 8 / k) AS int) = j)) "
                                  "- n / 8, 2) / (n / 8))"))
    share = (f"CASE j WHEN 0 THEN char_length(regexp_replace(alphabet, '[^0-9]', '')) "
             f"WHEN 1 THEN char_length(regexp_replace(alphabet, '[^a-z]', '')) "
             f"WHEN 2 THEN char_length(regexp_replace(alphabet, '[^A-Z]', '')) ELSE 0 END")
    t = t.withColumn("xc", F.expr(f"aggregate(transform(sequence(0, 2), j -> named_struct('o', size(filter(c, y -> y = j)), "
                                  f"'e', n * ({share}) / k)), 0D, (a, y) -> a + IF(y.e > 0, pow(y.o - y.e, 2) / y.e, 0D))"))
    # Runs about the middle of the alphabet.
    t = t.withColumn("hi", F.expr("transform(v, y -> IF(y * 2 >= k, 1, 0))"))
    t = t.withColumn("n1", F.expr("aggregate(hi, 0D, (a, y) -> a + y)")).withColumn("n2", F.expr("n - n1"))
    t = t.withColumn("runs", F.expr("1 + size(filter(sequence(1, CAST(n AS int) - 1), i -> hi[i] <> hi[i - 1]))"))
    t = t.withColumn("mu", F.expr("2 * n1 * n2 / n + 1"))
    t = t.withColumn("zr", F.expr("IF(n1 * n2 = 0, 30D, abs(runs - mu) / sqrt(greatest(1e-9, (mu - 1) * (mu - 2) / (n - 1))))"))
    # Serial correlation of neighbours, with letter case and without it (letters in
    # order are in order whatever their case).
    for x, z in (("v", "zv"), ("f", "zf")):
        t = t.withColumn("mean", F.expr(f"aggregate({x}, 0D, (a, y) -> a + y) / n"))
        t = t.withColumn("s2", F.expr(f"aggregate({x}, 0D, (a, y) -> a + pow(y - mean, 2))"))
        t = t.withColumn("s1", F.expr(f"aggregate(sequence(1, CAST(n AS int) - 1), 0D, (a, i) -> a + ({x}[i] - mean) * ({x}[i - 1] - mean))"))
        t = t.withColumn(z, F.expr("IF(s2 = 0, 30D, abs(s1 / s2 + 1 / n) * sqrt(n))"))
    # The larger of two, so its p-value counts twice.
    t = t.withColumn("zs", F.expr("greatest(zv, zf)"))
    parts = [_chi2_tail("x8", 7), _chi2_tail("greatest(xc, 1e-6)", 2), f"2 * {_upper_tail('zr')}", f"4 * {_upper_tail('zs')}"]
    logs = " + ".join(f"-ln(greatest(1e-300, least(1D, {p})))" for p in parts)
    t = t.withColumn("half", F.expr(logs))          # half of Fisher's statistic, 8 degrees of freedom
    t = t.withColumn("refuted", F.expr("exp(-half) * (1 + half + half * half / 2 + half * half * half / 6)"))
    # Changes of class against the null of ordinary tokens.
    t = t.withColumn("changes", F.expr("size(filter(sequence(1, CAST(n AS int) - 1), i -> c[i] <> c[i - 1]))"))
    z0 = f"((changes - 0.5 - (n - 1) * {SWITCH}) / sqrt((n - 1) * {SWITCH * (1 - SWITCH)}))"
    # Likelihood under the pairs of ordinary text over that of a random token.
    size = len(FOLDED)
    t = t.withColumn("enc", F.expr(
        "CASE WHEN k = 16 THEN 0 WHEN k = 26 THEN 1 WHEN k = 32 THEN 2 WHEN k = 36 THEN 3 ELSE 4 END"))
    # One row, so that the numbers do not stand in every plan node.
    numbers = [F.expr("transform(split('" + ",".join(map(repr, x)) + "', ','), y -> CAST(y AS double))").alias(name)
               for name, x in (("ratio", ratios), ("ordinary", ordinary))]
    t = t.crossJoin(F.broadcast(tokens.sparkSession.range(1).select(*numbers))).withColumn("lr", F.expr(
        f"aggregate(sequence(1, CAST(n AS int) - 1), get(ratio, {len(ENCODINGS) * size * size} + enc * {size} + f[0]), "
        f"(a, i) -> a + get(ratio, enc * {size * size} + f[i - 1] * {size} + f[i]))"))
    best = ", ".join([_upper_tail(z0), "exp(least(0D, lr))", *_turned_round()])
    t = t.withColumn("p0", F.expr(f"IF(refuted < {REFUTED}, 1D, greatest(1e-40, least(1D, 5 * least({best}))))"))
    return t.drop("ratio", "ordinary")


def _thresholds(histogram: list, rate: float) -> dict[int, int]:
    """Least bin that is a discovery, by stratum (Benjamini-Hochberg on the bins).

    The p-values of a bin are taken at its upper end, so the rate holds."""
    out: dict[int, int] = {}
    for stratum in {r.stratum for r in histogram}:
        rows = sorted(((r.bin, r.n) for r in histogram if r.stratum == stratum), reverse=True)
        total, seen = sum(n for _, n in rows), 0
        for b, n in rows:
            seen += n
            if 10 ** (-b * BIN) <= rate * seen / total:
                out[stratum] = b
    return out


def secret_scan(docs: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans,
    and n_random, the number of spans that the method added.

    Spans are kind:start:end (code points, end exclusive), by start, then in the
    order assign, access, hex, random.  Defined cases: null text counts as empty
    (no spans; the hash of the empty string); repeated rows are scanned each; a
    null id is passed on; texts are scanned whole; an empty table gives no rows;
    extra columns are not read.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = src.select("doc_id", F.expr(_spans(ASSIGN)).alias("assign"), F.expr(_spans(ACCESS_SCAN)).alias("access"),
                       F.expr(_spans(HEX_SCAN)).alias("hex"), F.expr(_spans(TOKEN_SCAN)).alias("token"))
    found = found.withColumn("assign", F.expr(
        f"filter(assign, x -> char_length(regexp_extract(x.m, r'{ASSIGN}', 1)) >= {LEAST_ASSIGNED})"))
    found = found.withColumn("base", F.expr(
        "array_sort(concat(transform(assign, x -> struct(x.s AS s, 0 AS k, x.e AS e)), "
        "transform(access, x -> struct(x.s AS s, 1 AS k, x.e AS e)), transform(hex, x -> struct(x.s AS s, 2 AS k, x.e AS e))))"))
    found = found.withColumn("token", F.expr(
        f"IF(size(token) = 0 OR size(base) = 0, token, {_apart()})"))
    # Only places and counts go on, never texts.
    rows = cut(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("assign").alias("n_assign"),
                            F.size("access").alias("n_access"), F.size("hex").alias("n_hex"), "base", "token"))
    tokens = rows.where("size(token) > 0").select("row", F.explode("token").alias("x")).select("row", "x.s", "x.e", "x.m")
    stratum = F.expr("CASE " + " ".join(f"WHEN n >= {a} THEN {a}" for a in sorted(STRATA, reverse=True)) + " ELSE 0 END")
    pairs = _pairs(src)
    judged = (_battery(tokens, _log_ratios(pairs), _ordinary(pairs)).withColumn("stratum", stratum)
              .withColumn("bin", F.expr(f"CAST(least({BINS}, floor(-log10(p0) / {BIN})) AS int)"))
              .select("row", "s", "e", "stratum", "bin", "refuted"))
    judged = cut(judged)
    histogram = judged.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")).collect()   # strata x bins rows
    least = _thresholds(histogram, rate)
    passes = F.lit(False)
    for s, b in least.items():
        passes = passes | ((F.col("stratum") == s) & (F.col("bin") >= b))
    random = (judged.where(passes & (F.col("refuted") >= REFUTED))
              .groupBy("row").agg(F.collect_list(F.expr("struct(s AS s, 3 AS k, e AS e)")).alias("random")))
    names = "element_at(array('assign', 'access', 'hex', 'random'), x.k + 1)"
    text = f"array_join(transform({{}}, x -> concat({names}, ':', x.s, ':', x.e)), ',')"
    out = rows.drop("token").join(random, "row", "left")
    return out.select(
        "doc_id", F.col("n_assign").cast("long").alias("n_assign"), F.col("n_access").cast("long").alias("n_access"),
        F.col("n_hex").cast("long").alias("n_hex"), F.sha2(F.expr(text.format("base")), 256).alias("base_sha256"),
        F.expr(text.format("array_sort(concat(base, coalesce(random, CAST(array() AS array<struct<s:int,k:int,e:int>>))))")).alias("spans"),
        F.when(F.col("random").isNull(), 0).otherwise(F.size("random")).cast("long").alias("n_random"))
