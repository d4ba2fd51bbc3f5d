"""Native column expressions over sequences, identifiers and headers.

All take and give Columns (strings name columns), evaluate in the JVM, and give NULL for NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "after_gap_free", "back_translate", "before_dot", "block_key", "chars", "clean_id", "coalescent_density", "codon_positions", "drop_direction", "ending_kmers",
    "file_number", "gap_counts", "gene_of_isoform", "is_all_missing", "iupac_code", "let", "orf_header", "partner_file", "pick_sites", "ratio", "reverse_complement",
    "species_list", "species_of", "strip_gene_labels", "strip_residues", "taxon_name", "threshold_label", "translate_codons", "triplet_parts",
    "trim_quality", "unescape", "windows_of", "wrap",
]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double; NULL where b is 0."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, not once for each element that uses it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def pick_sites(seq: Column | str, sites: Column | str, fill: str = "-") -> Column:
    """The characters at some positions (from 1), ``fill`` beyond the end."""
    return let(chars(seq), lambda c: F.array_join(F.transform(_c(sites), lambda p: F.coalesce(F.get(c, p.cast("int") - 1), F.lit(fill))), ""))


def ending_kmers(seq: Column | str, longest: int, first: int = 0) -> Column:
    """For every position from ``first`` (0-based): struct of ``i`` (counted from ``first``) and the k-mer of up
    to ``longest`` bases that ends there."""
    def at(c: Column) -> Column:
        gram = lambda i: F.array_join(F.slice(c, F.greatest(i + 2 - longest, F.lit(1)) + first, F.least(i + 1, F.lit(longest))), "")
        places = F.when(F.size(c) > first, F.sequence(F.lit(0), F.size(c) - 1 - first)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(i.alias("i"), gram(i).alias("kmer")))

    return let(chars(seq), at)


def windows_of(seq: Column | str, k: int, step: int = 1) -> Column:
    """Distinct windows of ``k`` characters, every ``step``-th."""
    def at(c: Column) -> Column:
        starts = F.when(F.size(c) >= k, F.sequence(F.lit(1), F.size(c) - (k - 1), F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(c, i, k), "")))

    return let(chars(seq), at)


def chars(seq: Column | str) -> Column:
    """Array of the characters."""
    return F.when(F.length(_c(seq)) > 0, F.split(_c(seq), "")).otherwise(F.array().cast("array<string>"))


# identifiers ------------------------------------------------------------------------------------


def clean_id(header: Column | str) -> Column:
    """First space-separated token, slashes and backslashes as underscores."""
    return F.translate(F.split_part(_c(header), F.lit(" "), F.lit(1)), "/\\", "__")


def taxon_name(name: Column | str) -> Column:
    """Letters, digits and underscores only, no leading digit, 99 characters at most."""
    plain = F.regexp_replace(_c(name), "[^A-Za-z0-9_]", "_")
    return F.substring(F.when(plain.rlike("^[0-9]"), F.concat(F.lit("T"), plain)).otherwise(plain), 1, 99)


def strip_residues(seq: Column | str, residues: str = "*") -> Column:
    """The sequence without some symbols ("*" stops, "-*" gaps and stops)."""
    return F.translate(_c(seq), residues, "")


def drop_direction(text: Column | str) -> Column:
    """Aligners mark reversed sequences by _R_ in the name."""
    return F.replace(_c(text), F.lit("_R_"), F.lit(""))


def strip_gene_labels(newick: Column | str) -> Column:
    """Tree text with ``species++gene`` labels cut to the species."""
    return F.regexp_replace(_c(newick), r"\+\+[^,:;()]+", "")


def species_of(label: Column | str) -> Column:
    return F.split_part(_c(label), F.lit("++"), F.lit(1))


def species_list(labels: Column | str) -> Column:
    """Distinct species of an array of labels, in the order of first appearance."""
    return F.array_distinct(F.transform(_c(labels), lambda x: F.split_part(x, F.lit("++"), F.lit(1))))


def gene_of_isoform(isoform: Column | str, pattern: str = r"^(.*)_i\d+$") -> Column:
    """Gene of an isoform id: the pattern's group, else what stands before the last underscore, else NULL."""
    by_pattern = F.nullif(F.regexp_extract(_c(isoform), pattern, 1), F.lit(""))
    return F.coalesce(by_pattern, F.nullif(F.regexp_extract(_c(isoform), "^(.*)_[^_]*$", 1), F.lit("")))


def partner_file(species: Column | str) -> Column:
    """Name of the coding-sequence file for a protein file (or itself)."""
    return F.regexp_replace(_c(species), r"\.(pep|cds)$", ".cds")


def before_dot(name: Column | str) -> Column:
    return F.split_part(_c(name), F.lit("."), F.lit(1))


def unescape(text: Column | str) -> Column:
    """Percent escapes decoded; a plus sign stays."""
    return F.url_decode(F.replace(_c(text), F.lit("+"), F.lit("%2B")))


def file_number(name: Column | str) -> Column:
    """Ordinal in a file name: after "ortho", else leading, else trailing before the suffix, else any; else infinity."""
    forms = [r"ortho(\d+)", r"^(\d+)", r"(\d+)(?:\.[^.]*)?$", r"(\d+)"]
    found = [F.nullif(F.regexp_extract(_c(name), p, 1), F.lit("")).try_cast("double") for p in forms]
    return F.coalesce(*found, F.lit(float("inf")))


def threshold_label(threshold: Column | str) -> Column:
    """0.1 as 0p1."""
    return F.replace(_c(threshold).cast("string"), F.lit("."), F.lit("p"))


def triplet_parts(text: Column | str, leaves: Column | str) -> Column:
    """The three taxa of ``a_b_c`` where names may hold underscores: of all ways to cut the text into
    three of ``leaves``, the one with the shortest first and then second name; NULL if there is none."""
    text, leaves = _c(text), _c(leaves)
    firsts = F.filter(leaves, lambda a: text.startswith(F.concat(a, F.lit("_"))))

    def rest(a: Column) -> Column:
        tail = F.substr(text, F.length(a) + 2)
        mids = F.filter(leaves, lambda b: tail.startswith(F.concat(b, F.lit("_"))) & F.array_contains(leaves, F.substr(tail, F.length(b) + 2)))
        return F.transform(mids, lambda b: F.struct(F.length(a).alias("x"), F.length(b).alias("y"), F.array(a, b, F.substr(tail, F.length(b) + 2)).alias("taxa")))

    return F.try_element_at(F.array_sort(F.flatten(F.transform(firsts, rest))), F.lit(1))["taxa"]


def orf_header(header: Column | str) -> Column:
    """Struct of length, strand, contig, start and stop out of ``len:n (s) contig:a-b(s)``."""
    form = r"len:(\d+)\s+\(([+-])\)\s+(?:.*\s)?(\S+):(\d+)-(\d+)\([+-]\)"
    get = lambda g: F.nullif(F.regexp_extract(_c(header), form, g), F.lit(""))
    return F.struct(get(1).cast("long").alias("length"), get(2).alias("strand"), get(3).alias("contig"), get(4).cast("long").alias("start"), get(5).cast("long").alias("stop"))


# sequence text ----------------------------------------------------------------------------------


def is_all_missing(seq: Column | str, symbols: str = "-?Nn") -> Column:
    """Nothing but missing-base symbols (an empty sequence too)."""
    return _c(seq).rlike(f"^[{symbols.replace('-', '')}{'-' if '-' in symbols else ''}]*$")


def after_gap_free(seq: Column | str) -> Column:
    return F.translate(_c(seq), "-?", "")


def reverse_complement(seq: Column | str) -> Column:
    return F.reverse(F.translate(_c(seq), "ACGTacgt", "TGCAtgca"))


#: Amino acids of the 64 codons in the order TCAG, by public numbering of genetic codes.
GENETIC_CODES = {
    1: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    2: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG",
    4: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    5: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSSSVVVVAAAADDEEGGGG",
    6: "FFLLSSSSYYQQCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    11: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    12: "FFLLSSSSYY**CC*WLLLSPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
}


def translate_codons(seq: Column | str, code: int = 1) -> Column:
    """Amino acids of frame 1; codons with other letters give X, a rest of 1 or 2 bases nothing."""
    acids = GENETIC_CODES[code]
    place = lambda c, i: F.call_function("instr", F.lit("TCAG"), F.substring(c, i, 1)) - 1

    def acid(codon: Column) -> Column:
        k = place(codon, 1) * 16 + place(codon, 2) * 4 + place(codon, 3)
        known = codon.rlike("^[TCAG]{3}$")
        return F.when(known, F.substr(F.lit(acids), k + 1, F.lit(1))).otherwise("X")

    return F.array_join(F.transform(F.regexp_extract_all(F.upper(_c(seq)), F.lit("(?s)(.{3})"), F.lit(1)), acid), "")


#: Ambiguity codes of sets of bases.
IUPAC = {"AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M", "CGT": "B", "AGT": "D", "ACT": "H", "ACG": "V", "ACGT": "N"}


def iupac_code(alleles: Column | str) -> Column:
    """One letter for a set (array) of bases: itself for one, N for none or an unknown set."""
    key = F.array_join(F.array_sort(F.array_distinct(F.transform(_c(alleles), F.upper))), "")
    table = F.create_map(*[F.lit(x) for pair in IUPAC.items() for x in pair])
    return F.when(key.rlike("^[ACGT]$"), key).otherwise(F.coalesce(F.try_element_at(table, key), F.lit("N")))


def back_translate(protein: Column | str, cds: Column | str) -> Column:
    """Codon alignment of a gapped protein: a gap gives ---, a stop gives --- and takes a codon.

    A coding length that is no multiple of 3 raises.
    """
    zero = F.struct(F.lit(0).alias("i"), F.lit("").alias("out"))

    def step(codons: Column, acc: Column, c: Column) -> Column:
        said = F.when(c.isin("-", "*"), F.lit("---")).otherwise(F.coalesce(F.get(codons, acc["i"]), F.lit("")))
        return F.struct((acc["i"] + F.when(c == "-", 0).otherwise(1)).alias("i"), F.concat(acc["out"], said).alias("out"))

    fold = lambda codons: F.aggregate(chars(protein), zero, lambda acc, c: step(codons, acc, c), lambda acc: acc["out"])
    folded = let(F.regexp_extract_all(_c(cds), F.lit("(?s)(.{3})"), F.lit(1)), fold)
    return F.when(F.length(_c(cds)) % 3 == 0, folded).otherwise(F.raise_error(F.lit("coding length is no multiple of 3")).cast("string"))


def codon_positions(seq: Column | str) -> Column:
    """Array of the three codon-position subsequences."""
    def every_third(k: int) -> Column:
        return F.array_join(F.filter(chars(seq), lambda _, i: i % 3 == k), "")

    return F.array(*map(every_third, range(3)))


def block_key(pos: Column | str, size: int = 50_000) -> Column:
    return F.floor(_c(pos) / size)


def wrap(seq: Column | str, width: int = 80) -> Column:
    """Lines of ``width`` symbols, no line break at the end."""
    return F.regexp_replace(F.regexp_replace(_c(seq), f"(.{{{width}}})", "$1\n"), "\n$", "")


def gap_counts(seq: Column | str, symbol: str = "-") -> Column:
    return (F.length(_c(seq)) - F.length(F.replace(_c(seq), F.lit(symbol), F.lit("")))).cast("long")


def trim_quality(seq: Column | str, qual: Column | str, *, leading: int = 3, trailing: int = 3, window: int = 4, mean: int = 15, head: int = 8, least: int = 36) -> Column:
    """Struct seq, qual of a trimmed read (Phred+33), or NULL where fewer than ``least`` bases are left.

    In order: leading and trailing low bases, then the read is cut at the start of the first window
    whose mean quality is under ``mean``, then ``head`` bases off the start.
    """
    def bounds(q: Column) -> Column:
        good = lambda limit: F.filter(F.transform(q, lambda v, i: F.when(v >= limit, i)), lambda i: i.isNotNull())
        return F.struct(F.array_min(good(leading)).alias("first"), F.array_max(good(trailing)).alias("last"), q.alias("q"))

    def kept(b: Column) -> Column:
        part = F.slice(b["q"], b["first"] + 1, F.greatest(b["last"] - b["first"] + 1, F.lit(0)))
        return F.struct(b["first"].alias("first"), part.alias("q"))

    def size(b: Column) -> Column:
        sums = lambda i: F.aggregate(F.slice(b["q"], i, window), F.lit(0), lambda a, v: a + v)
        n = F.size(b["q"])
        places = F.when(n >= window, F.sequence(F.lit(1), n - window + 1)).otherwise(F.array().cast("array<int>"))
        low = F.array_min(F.filter(places, lambda i: sums(i) < mean * window))
        return F.struct((b["first"] + 1 + head).alias("at"), (F.coalesce(low - 1, n) - head).alias("n"))

    cut = lambda s, x: F.substr(_c(s), x["at"], x["n"])
    done = lambda x: F.when(x["n"] >= least, F.struct(cut(seq, x).alias("seq"), cut(qual, x).alias("qual")))
    q = F.transform(chars(qual), lambda c: F.ascii(c) - 33)
    return let(q, lambda v: let(bounds(v), lambda b: let(kept(b), lambda k: let(size(k), done))))


# numeric forms ----------------------------------------------------------------------------------


def coalescent_density(x: Column | str, scale: Column | str, c: Column | str) -> Column:
    """Two-component coalescent density at branch length ``x`` with scale lambda and threshold C."""
    x, scale, c = _c(x), _c(scale), _c(c)
    far = 0.5 / scale * F.exp(-x / scale) * (1 + F.exp(c))
    near = F.sinh(x / scale) / (scale * (F.exp(c) - 1))
    return F.when(x >= c * scale, far).when(x > 0, near).otherwise(F.lit(0.0))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
