"""Labels as typed tokens: a scanner, folds over its arrays, and a reading for each family of groups.

A label is scanned into an array of tokens: the kind of word, the word, the subcategory it names, the brackets it stands in
and its place. A label with anything else in it has no tokens (null). Runs of tokens between separators are arrays of arrays, and
each reading is a rule over these. Everything is an expression of built-in functions; it reads distinct labels only.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import racewords as W

TOKEN = "struct<kind:string,text:string,sub:string,path:array<int>,pos:int,off:boolean,eg:boolean>"
STATE = f"struct<path:array<int>,opened:int,bad:boolean,out:array<{TOKEN}>>"


class Steps:
    """A reading's intermediate results, each a column of its own, so that no expression holds another many times over."""

    def __init__(self, name: str) -> None:
        self.name, self.made = name, []

    def let(self, column: Column) -> Column:
        self.made.append((f"_{self.name}_{len(self.made)}", column))
        return F.col(self.made[-1][0])

    def done(self, column: Column) -> list[tuple[str, Column]]:
        return [*self.made, (self.name, column)]


def plain(text: Column) -> Column:
    """Lower case without accents and ligatures; hyphens between letters as spaces, no dots or apostrophes, white space squashed."""
    z = F.translate(F.lower(text), "éèêëēáàâäãåāíìîïīóòôöõōúùûüūçñ", "eeeeeaaaaaaaiiiiioooooouuuuucn")
    z = F.regexp_replace(F.regexp_replace(z, "ﬁ", "fi"), "ﬂ", "fl")
    z = F.regexp_replace(F.regexp_replace(z, r"(?<=[a-z])-(?=[a-z])", " "), r"[.'’]", "")
    return F.trim(F.regexp_replace(z, r"\s+", " "))


def chosen(text: Column, table: list[tuple[str, str | None]]) -> Column:
    """What the first pattern that fits the whole text names."""
    out = None
    for pattern, value in table:
        fits = text.rlike(f"^(?:{pattern})$")
        value = F.lit(value).cast("string")
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def scanned(at: Steps, z: Column, kinds: dict[str, str], subs: list[tuple[str, str | None]] | None = None) -> Column:
    """Tokens of a plain text, null where it holds anything else or closes a bracket that is not open. Marks are of the kind mark, brackets open and close.
    subs: what names, places and directions stand for. off and eg are for the readings to set."""
    pattern = rf"(?:{'|'.join(kinds.values())})(?![a-z])|{W.MARK}"
    z = at.let(z)
    words = at.let(F.when(F.trim(F.regexp_replace(z, pattern, "")) == "", F.regexp_extract_all(z, F.lit(pattern), F.lit(0))))
    # the order of kinds decides, as in the pattern
    kind_of = lambda t: F.coalesce(F.when(t == "(", "open").when(t == ")", "close").when(t.rlike(f"^{W.MARK}$"), "mark"), chosen(t, [(p, k) for k, p in kinds.items()]))
    sub_of = lambda t: chosen(t, subs) if subs else F.lit(None).cast("string")
    typed = at.let(F.transform(words, lambda t: F.struct(kind_of(t).alias("kind"), t.alias("text"), sub_of(t).alias("sub"))))
    start = F.expr(f"cast(struct(array(), 0, false, array()) as {STATE})")

    def step(s: Column, t: Column) -> Column:
        opened = s.opened + F.when(t.kind == "open", 1).otherwise(0)
        inside = F.when(t.kind == "open", F.concat(s.path, F.array(opened))).otherwise(s.path)
        after = F.when(t.kind == "close", F.slice(s.path, F.lit(1), F.greatest(F.size(s.path) - 1, F.lit(0)))).otherwise(inside)
        token = F.struct(t.kind.alias("kind"), t.text.alias("text"), t.sub.alias("sub"), inside.alias("path"), F.size(s.out).alias("pos"), F.lit(False).alias("off"), F.lit(False).alias("eg"))
        return F.struct(after.alias("path"), opened.cast("int").alias("opened"), (s.bad | ((t.kind == "close") & (F.size(s.path) == 0))).alias("bad"), F.concat(s.out, F.array(token)).alias("out")).cast(STATE)

    done = at.let(F.aggregate(typed, start, step))
    return at.let(F.when(~done.bad, done.out))


def runs(tokens: Column, cuts: Callable[[Column], Column]) -> Column:
    """array<array<token>>: what stands between the tokens that cut."""

    def step(acc: Column, t: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.concat(last, F.array(t))))
        return F.when(cuts(t), F.concat(acc, F.array(F.filter(last, lambda x: F.lit(False))))).otherwise(grown)

    return F.aggregate(tokens, F.expr(f"cast(array(array()) as array<array<{TOKEN}>>)"), step)


def has(tokens: Column, *kinds: str) -> Column:
    return F.exists(tokens, lambda t: t.kind.isin(*kinds))


def first(tokens: Column, which: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(tokens, which), F.lit(0))


def last(tokens: Column) -> Column:
    return F.get(tokens, F.size(tokens) - 1)


def under(t: Column, path: Column) -> Column:
    """Whether a token stands in the brackets `path`, or deeper."""
    return (F.size(t.path) >= F.size(path)) & (F.slice(t.path, F.lit(1), F.size(path)) == path)


def outside(t: Column) -> Column:
    return F.size(t.path) == 0


def side_by_side(t: Column) -> Column:
    return t.kind.isin("join", "mark") & t.text.isin(*W.SIDE_BY_SIDE)


def whole(tokens: Column, ends: list[str], begins: list[str]) -> Column:
    """Whether the label is none cut off at a join."""
    return (F.size(tokens) > 0) & ~F.get(tokens, F.lit(0)).kind.isin("join", "mark", *begins) & ~last(tokens).kind.isin("join", "mark", *ends)


def common(subs: Column, regions: dict[str, str]) -> Column:
    """The one region of all subcategories, null where there are several or one has none."""
    table = F.create_map(*[F.lit(x) for kv in regions.items() for x in kv])
    found = F.array_distinct(F.transform(subs, lambda s: F.coalesce(F.try_element_at(table, s), F.lit(""))))
    return F.when((F.size(found) == 1) & (F.get(found, F.lit(0)) != ""), F.get(found, F.lit(0)))


def refined(subs: Column, regions: dict[str, str]) -> Column:
    """The subcategory that all others are or hold, else their one region."""
    table = F.create_map(*[F.lit(x) for kv in regions.items() for x in kv])
    fits = lambda c: F.forall(subs, lambda o: (c == o) | F.coalesce(F.try_element_at(table, c) == o, F.lit(False)))
    return F.coalesce(F.get(F.filter(subs, fits), F.lit(0)), common(subs, regions))


def agreed(subs: Column, regions: dict[str, str]) -> Column:
    """The subcategory of alternatives: the one of all, none where one has none, else their one region."""
    same = F.size(F.array_distinct(F.transform(subs, lambda s: F.coalesce(s, F.lit(""))))) == 1
    return F.when(same, F.get(subs, F.lit(0))).when(F.forall(subs, lambda s: s.isNotNull()), common(subs, regions))


def reading(category: str, subcategory: Column | None = None) -> Column:
    sub = F.lit(None).cast("string") if subcategory is None else subcategory.cast("string")
    return F.struct(F.lit(category).alias("category"), sub.alias("subcategory"))


@functools.cache
def mena(text: str, name: str) -> list[tuple[str, Column]]:
    """Middle Eastern or North African groups only: White, with what they have in common."""
    at = Steps(name)
    term = "|".join(p for p, _ in W.MENA_TERMS)
    inner = at.let(F.regexp_extract(F.lower(F.col(text)), rf"^{W.MENA_BEFORE}((?:{term})(?:{W.MENA_JOIN}(?:{term}))*){W.MENA_AFTER}$", 1))
    kinds = at.let(F.array_distinct(F.transform(F.regexp_extract_all(inner, F.lit(rf"(?:{term})"), F.lit(0)), lambda t: chosen(t, W.MENA_TERMS))))
    eastern = F.forall(kinds, lambda k: k.isin("middle_eastern", "middle_eastern_arab", "middle_eastern_persian"))
    sub = F.when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).when(eastern, "middle_eastern").otherwise("middle_eastern_north_african")
    return at.done(F.when(inner != "", reading("white", sub)))


@functools.cache
def native_american(text: str, name: str) -> list[tuple[str, Column]]:
    """A name, or an indigenous people with a place of the Americas; abbreviations, tribes and directions only beside these."""
    at = Steps(name)
    t = scanned(at, F.trim(F.regexp_replace(F.regexp_replace(plain(F.col(text)), W.AIAN_GLOSS, " "), r"\s+", " ")), W.AIAN)
    named = has(t, "name")
    placed = (has(t, "indigenous") & has(t, "continent", "country")) | (has(t, "native") & has(t, "continent"))
    stray = (has(t, "abbrev", "tribe") & ~named) | (has(t, "direction") & ~named & ~has(t, "continent"))
    return at.done(F.when((named | placed) & ~stray, reading("american_indian_alaska_native")))


@functools.cache
def pacific(text: str, name: str) -> list[tuple[str, Column]]:
    """Hawaiians and Pacific Islanders, with the subcategory that all names share."""
    at = Steps(name)
    t = scanned(at, plain(F.col(text)), W.NHPI, W.NHPI_SUBS)
    subs = F.transform(F.filter(t, lambda x: x.kind == "name"), lambda x: F.coalesce(x.sub, F.lit("")))
    subs = at.let(F.array_distinct(F.when(has(t, "pacific", "abbrev"), F.concat(subs, F.array(F.lit("")))).otherwise(subs)))
    sub = F.when(F.size(subs) == 1, F.nullif(F.get(subs, F.lit(0)), F.lit("")))
    return at.done(F.when(has(t, "name") & whole(t, [], []), reading("native_hawaiian_pacific_islander", sub)))


@functools.cache
def census(text: str, name: str) -> list[tuple[str, Column]]:
    """A British census wording. A mixed heading lists its parts; other headings name one race, and a group after the last dash or colon is the subcategory."""
    at = Steps(name)
    raw = scanned(at, plain(F.col(text)), W.UK, W.UK_SUBS)
    t = at.let(F.transform(raw, lambda x, i: F.when((x.kind == "nation") & F.coalesce(F.get(raw, i - 1).kind.isin("asian", "black"), F.lit(False)), x.withField("kind", F.lit("british"))).otherwise(x)))
    ends = ["mark", "or", "and"]
    cut_off = at.let((F.size(t) == 0) | F.get(t, F.lit(0)).kind.isin(*ends) | last(t).kind.isin(*ends))
    races = at.let(F.array_distinct(F.array_compact(F.transform(t, lambda x: chosen(x.kind, list(W.UK_RACES.items()))))))
    nations = F.size(F.filter(t, lambda x: x.kind == "nation"))
    mixes = at.let(F.size(F.filter(t, lambda x: x.kind == "mixed")))
    says = at.let(has(t, "british") | (has(t, "other") & has(t, "background")) | ((nations > 0) & (has(t, "white") | (nations >= 2))) | ((mixes > 0) & (has(t, "ethnic") | (mixes > 1) | (F.size(races) >= 2))))

    start = at.let(first(t, lambda x: x.kind == "mixed").pos)
    heading_end = at.let(first(t, lambda x: (x.kind == "mark") & x.text.isin(*W.DASHES) & (x.pos > start)).pos)
    heading = at.let(F.filter(t, lambda x: heading_end.isNull() | (x.pos < heading_end)))
    either = at.let(runs(heading, lambda x: outside(x) & (x.kind == "or")))
    joined = at.let(runs(heading, lambda x: outside(x) & (x.kind.isin("or", "and") | ((x.kind == "mark") & (x.text == "&")))))
    listed = at.let(runs(t, lambda x: outside(x) & (x.kind == "mark") & x.text.isin("/", ",", ";")))
    pure = lambda parts: F.forall(parts, lambda p: (F.size(p) == 0) | has(p, "mixed"))
    second = F.exists(F.slice(joined, F.lit(2), F.greatest(F.size(joined) - 1, F.lit(0))), lambda p: has(p, "ethnic") & ~has(p, "mixed"))
    mixed = at.let(pure(either) & ~second & (heading_end.isNotNull() | pure(listed)))

    sides = at.let(runs(t, lambda x: outside(x) & (x.kind.isin("or", "and") | ((x.kind == "mark") & x.text.isin("/", ",", ";", "&")))))
    named = F.forall(sides, lambda p: (F.size(p) == 0) | has(p, *W.UK_GROUPS)) & (F.size(races) == 1)
    groups = lambda ts: F.array_distinct(F.transform(F.filter(ts, lambda x: x.kind.isin("asian_sub", "black_sub")), lambda x: x.sub))
    dash = at.let(F.array_max(F.transform(F.filter(t, lambda x: (x.kind == "mark") & x.text.isin(*W.DASHES)), lambda x: x.pos)))
    tail = at.let(F.filter(t, lambda x: x.pos > dash))
    everywhere, behind = at.let(groups(t)), at.let(groups(tail))
    sole = lambda g: F.when(F.size(g) == 1, F.get(g, F.lit(0)))
    in_tail = F.when(dash.isNotNull() & ~has(tail, "asian", "black", "white"), sole(behind))
    sub = F.when(~has(t, "other"), F.coalesce(in_tail, sole(everywhere)))
    one = F.struct(F.get(races, F.lit(0)).alias("category"), sub.alias("subcategory"))
    return at.done(F.when(says & ~cut_off & (mixes > 0) & mixed, reading("more_than_one_race")).when(says & ~cut_off & (mixes == 0) & named, one))


@functools.cache
def european(text: str, name: str) -> list[tuple[str, Column]]:
    """European names, nationalities and Roma groups; each alternative names one. All directions east or west are a subcategory."""
    at = Steps(name)
    t = scanned(at, plain(F.col(text)), W.EUROPEAN)
    nations = at.let(F.array_distinct(F.transform(F.filter(t, lambda x: (x.kind == "nationality") & x.text.isin(*W.UK_NATIONS)), lambda x: x.text)))
    british = at.let(~has(t, "name", "roma", "traveller") & (F.size(nations) > 0) & (has(t, "white") | (F.size(nations) >= 2)))
    joins = at.let(F.transform(F.filter(t, side_by_side), lambda x: x.text))
    sides = at.let(F.transform(runs(t, side_by_side), lambda s: F.filter(s, lambda x: ~x.kind.isin("filler", "open", "close", "mark", "join"))))
    kind_at = lambda s, i: F.get(s, i).kind
    directions = lambda s: F.transform(F.filter(s, lambda x: x.kind == "direction"), lambda x: x.text)
    bare = lambda s: (F.size(s) > 0) & F.forall(s, lambda x: x.kind == "direction")
    facts = at.let(
        F.transform(
            sides,
            lambda s, i: F.struct(
                F.size(s).alias("n"), bare(s).alias("bare"), kind_at(s, F.lit(0)).alias("first"), has(s, "name").alias("named"), has(s, "white", "nationality", "roma", "traveller").alias("group"), directions(s).alias("directions"), F.get(joins, i).alias("join")
            ),
        )
    )
    next_solid = lambda i: F.get(F.filter(F.slice(facts, i + 2, F.size(facts)), lambda f: (f.n > 0) & ~f.bare), F.lit(0))
    new_zealand = lambda f: (f.n == 1) & (f["first"] == "new_zealand")
    apposed = lambda f, i: (f.join == ",") & (F.get(facts, i + 1)["first"] == "name")
    lends = lambda f: (f["first"] == "direction") & f.named
    stands = at.let(
        F.transform(facts, lambda f, i: F.coalesce(F.when(f.n == 0, True).when(f.bare, lends(next_solid(i))).when(new_zealand(f), apposed(f, i)).otherwise(f.named | f.group), F.lit(False)))
    )
    groups = at.let(F.transform(F.filter(facts, lambda f: (f.n > 0) & ~new_zealand(f)), lambda f: F.when(f.bare | f.named, f.directions).otherwise(F.array().cast("array<string>"))))
    every = lambda start: F.forall(groups, lambda g: F.forall(g, lambda d: d.startswith(start)))
    qualified = (F.size(groups) > 0) & F.forall(groups, lambda g: F.size(g) > 0)
    sub = F.when(has(t, "roma", "traveller"), None).when(qualified & every("east"), "european_eastern").when(qualified & every("west"), "european_western").otherwise("european")
    return at.done(F.when(has(t, "name", "nationality", "roma") & whole(t, [], []) & ~british & F.forall(stands, lambda ok: ok), reading("white", sub)))


@functools.cache
def asian(text: str, name: str) -> list[tuple[str, Column]]:
    """Asian groups, each alternative naming one. Negations take out what follows them, examples name members of a wider group. category `west`: qualified by west, to be read by its table."""
    at = Steps(name)
    raw = scanned(at, plain(F.col(text)), W.ASIAN, W.ASIAN_SUBS)
    naming = ["name", "place", "subcontinent", "indian"]
    cut = lambda x: side_by_side(x) & outside(x)
    split = at.let(F.transform(runs(raw, cut), lambda s: F.filter(s, lambda x: x.kind.isin(*naming, "direction", "negation", "other", "example", "open", "close"))))
    joins = at.let(F.transform(F.filter(raw, cut), lambda x: x.text))
    head = F.get(split, F.lit(0))
    heads = (F.size(split) == 2) & (F.get(joins, F.lit(0)) == ",") & (F.size(head) == 1) & F.get(head, F.lit(0)).text.isin("asian", "asians")
    merged = at.let(F.when(heads, F.array(F.flatten(split))).otherwise(split))
    # off: a negation stands before it in its brackets; eg: it is one of some examples, or stands beside "other" in brackets
    denied = lambda s, x: F.exists(s, lambda n: (n.kind == "negation") & (n.pos < x.pos) & under(x, n.path))
    example = lambda s, x: F.exists(s, lambda e: ((e.kind == "example") | ((e.kind == "other") & ~outside(e))) & under(x, e.path))
    marked = at.let(F.transform(merged, lambda s: F.transform(s, lambda x: x.withField("off", denied(s, x)).withField("eg", example(s, x)))))
    company = at.let(F.exists(marked, lambda s: F.exists(s, lambda x: x.kind.isin("name", "place", "subcontinent") & ~x.off)))
    counts = lambda x: x.kind.isin(*naming, "direction") & ~x.off & ((x.kind != "indian") | company)
    specific = lambda s: F.filter(s, lambda x: counts(x) & ~x.eg)
    is_west = lambda x: (x.kind == "direction") & x.text.startswith("west")
    facts = at.let(
        F.transform(
            marked,
            lambda s: F.struct(
                F.size(s).alias("n"),
                ((F.size(s) > 0) & F.forall(s, lambda x: x.kind == "direction")).alias("bare"),
                F.get(s, F.lit(0)).kind.alias("first"),
                last(s).kind.alias("last"),
                F.exists(s, lambda x: counts(x) & x.kind.isin("name", "subcontinent", "indian")).alias("names"),
                F.exists(s, lambda x: counts(x) & ~x.eg & is_west(x)).alias("west"),
                F.exists(s, lambda x: counts(x) & ~x.eg & (x.text == "central")).alias("central"),
                F.array_compact(F.transform(specific(s), lambda x: x.sub)).alias("subs"),
            ),
        )
    )
    solid = lambda fs: F.filter(fs, lambda f: (f.n > 0) & ~f.bare)
    following = lambda i: F.get(solid(F.slice(facts, i + 2, F.size(facts))), F.lit(0))
    previous = lambda i: F.get(F.reverse(solid(F.slice(facts, F.lit(1), i))), F.lit(0))
    shares = lambda i: F.coalesce((following(i)["first"] == "direction") & following(i).names, F.lit(False)) | F.coalesce((previous(i)["last"] == "direction") & previous(i).names, F.lit(False))
    stands = at.let(F.transform(facts, lambda f, i: F.when(f.n == 0, True).when(f.bare, shares(i)).otherwise(f.names)))
    full = at.let(F.filter(facts, lambda f: f.n > 0))
    subs = at.let(F.transform(full, lambda f: F.when(~f.central & (F.size(f.subs) > 0), refined(f.subs, W.ASIAN_REGIONS))))
    good = at.let(~has(raw, "west_indian") & whole(raw, ["open"], ["close"]) & (F.size(full) > 0) & F.forall(stands, lambda ok: ok))
    pending = F.exists(full, lambda f: f.west) & ~has(raw, "subcontinent")
    return at.done(F.when(good & pending, reading("west")).when(good, reading("asian", agreed(subs, W.ASIAN_REGIONS))))


@functools.cache
def black(text: str, name: str) -> list[tuple[str, Column]]:
    """Black groups, each alternative and each choice in a bracket naming one. Names in brackets refine the names before them; examples, and names listed beside "other", name no subcategory.
    Brackets within brackets count with the choice that holds them."""
    at = Steps(name)
    z = F.regexp_replace(plain(F.regexp_replace(F.lower(F.col(text)), W.BLACK_GLOSS, " ")), r"\bafrican\s*[\-–—/]\s*american", "african american")
    raw = scanned(at, z, W.BLACK, W.BLACK_SUBS)
    named_at_all = at.let(has(raw, "name"))
    is_name = lambda x: (x.kind == "name") | ((x.kind == "abbrev") & named_at_all)
    words = ["name", "abbrev", "place", "direction", "other", "example", "qualifier", "open", "close"]
    top = lambda x: side_by_side(x) & outside(x)

    # Brackets that hold choices of their own: their path, their place and the choices.
    brackets = at.let(F.filter(raw, lambda b: (b.kind == "open") & F.exists(raw, lambda x: side_by_side(x) & (x.path == b.path))))
    edge = lambda x, b: x.kind.isin("open", "close") & (x.path == b.path)
    parts = lambda b: runs(F.filter(raw, lambda x: under(x, b.path) & ~edge(x, b)), lambda x: side_by_side(x) & (x.path == b.path))
    choices = at.let(F.transform(brackets, lambda b: F.struct(b.path.alias("path"), b.pos.alias("pos"), parts(b).alias("parts"))))
    facts = at.let(
        F.transform(
            choices,
            lambda c: F.transform(
                c.parts,
                lambda p: F.struct(
                    F.exists(p, is_name).alias("named"),
                    has(p, "example").alias("example"),
                    F.forall(p, lambda x: x.kind == "example").alias("bare"),
                    (has(p, "other") & ~has(p, "qualifier") & ~F.exists(p, lambda x: x.text.isin(*W.ANY_RACE_WORDS))).alias("other"),
                    (has(p, "other") & ~has(p, "name")).alias("open"),
                ),
            ),
        )
    )
    # A choice without a name may only be the other Black groups, beside choices that name or exemplify.
    fits = lambda f, fs, i: f.named | f.bare | (f.other & (f.example | F.exists(F.filter(fs, lambda g, j: j != i), lambda g: g.named | g.example)))
    chosen_well = at.let(F.forall(facts, lambda fs: F.forall(F.transform(fs, lambda f, i: fits(f, fs, i)), lambda ok: ok)))
    # A bracket with a bare "other" only lists members of its group.
    listing = at.let(F.transform(F.filter(F.arrays_zip(choices.alias("c"), facts.alias("f")), lambda z: F.exists(z.f, lambda f: f.open)), lambda z: z.c.path))

    # eg: an example, or listed; off: "indigenous" whose choice is not of African names only
    sides0 = at.let(runs(raw, top))
    eg = lambda s, x: F.exists(s, lambda e: (e.kind == "example") & ((~outside(e) & under(x, e.path)) | (outside(e) & (x.pos > e.pos)))) | F.exists(listing, lambda path: under(x, path))
    sides = at.let(F.transform(sides0, lambda s: F.transform(s, lambda x: x.withField("eg", (x.kind == "name") & eg(s, x)))))
    counted = at.let(F.filter(F.flatten(sides), lambda x: (x.kind == "name") & ~x.eg))
    holds = lambda ts, x: F.exists(ts, lambda y: y.pos == x.pos)
    all_parts = at.let(F.flatten(F.transform(choices, lambda c: c.parts)))
    mates = lambda q: F.coalesce(first(all_parts, lambda p: holds(p, q)), first(sides, lambda s: holds(s, q)))
    african = lambda ts: F.exists(ts, lambda x: x.kind == "name") & F.forall(ts, lambda x: (x.kind != "name") | F.coalesce(x.sub == "african", F.lit(False)))
    native = at.let(F.forall(F.filter(raw, lambda x: (x.kind == "qualifier") & (x.text == "indigenous")), lambda q: african(mates(q))))

    # An alternative of fillers only must be part of a heading before a colon.
    joins = at.let(F.transform(F.filter(raw, top), lambda x: x.text))
    spoken = lambda s: F.filter(s, lambda x: x.kind.isin(*words))
    outline = at.let(
        F.transform(
            sides,
            lambda s, i: F.struct(
                i.alias("i"),
                F.size(s).alias("n"),
                F.size(spoken(s)).alias("spoken"),
                F.exists(s, is_name).alias("named"),
                F.exists(s, lambda x: outside(x) & (x.text == ":")).alias("colon"),
                (F.forall(s, lambda x: (x.kind != "filler") | x.text.isin(*W.HEADING_WORDS)) & F.exists(s, lambda x: (x.kind == "filler") & x.text.isin(*W.DIMENSION_WORDS))).alias("worded"),
            ),
        )
    )
    colon = lambda i: first(outline, lambda o: o.colon & (o.i > i)).i
    heading = lambda o: F.coalesce(o.worded & F.forall(F.slice(joins, o.i + 1, F.greatest(colon(o.i) - o.i, F.lit(0))), lambda j: j.isin(*W.HEADING_JOINS)), F.lit(False))
    stands = at.let(F.forall(outline, lambda o: F.when(o.n == 0, True).when(o.spoken == 0, heading(o)).otherwise(o.named)))

    def narrowed(subs: Column) -> Column:
        """Of names that refine one another; Black beside African American is the category itself."""
        some = F.array_compact(subs)
        plain_black = F.exists(subs, lambda s: s.isNull()) & F.array_contains(some, "african_american")
        return F.when((F.size(some) > 0) & ~plain_black, refined(some, W.BLACK_REGIONS))

    # Each outer bracket with choices becomes one name; one that opens with a join takes the names before it as its first choice.
    outer = at.let(F.transform(F.filter(choices, lambda c: F.size(c.path) == 1), lambda c: c.withField("leads", (F.size(c.parts) > 1) & (F.size(F.get(c.parts, F.lit(0))) == 0)).withField("side", first(outline, lambda o: holds(F.get(sides, o.i), c)).i)))
    mine = at.let(F.transform(sides, lambda s: F.filter(s, lambda x: holds(counted, x))))
    alone = at.let(F.transform(mine, lambda s: F.filter(s, lambda x: ~F.exists(outer, lambda c: under(x, c.path)))))
    subs_in = lambda ts: F.transform(F.filter(ts, lambda x: holds(counted, x)), lambda x: x.sub)
    before = lambda c: F.filter(F.get(alone, c.side), lambda x: c.leads & (x.pos < c.pos))
    inside = at.let(F.transform(outer, lambda c: c.withField("subs", F.filter(F.transform(F.concat(F.array(before(c)), c.parts), subs_in), lambda x: F.size(x) > 0))))
    inside = at.let(F.transform(F.filter(inside, lambda c: F.size(c.subs) > 0), lambda c: c.withField("each", F.transform(c.subs, narrowed))))
    joint = lambda c: agreed(c["each"], W.BLACK_REGIONS)
    simple = lambda c: (F.size(c["each"]) == 1) | F.forall(c["each"], lambda x: x.isNull())
    inside = at.let(F.transform(inside, lambda c: F.struct(c.side.alias("side"), c.pos.alias("pos"), c.leads.alias("leads"), F.when(simple(c), F.get(c["each"], F.lit(0))).otherwise(joint(c)).alias("sub"), (~simple(c) & joint(c).isNull()).alias("forced"))))
    rest = lambda s, i: F.transform(F.filter(s, lambda x: ~F.exists(inside, lambda c: (c.side == i) & c.leads & (x.pos < c.pos))), lambda x: x.sub)
    of_side = lambda i: F.filter(inside, lambda c: c.side == i)
    subs = at.let(F.transform(alone, lambda s, i: F.when(~F.exists(of_side(i), lambda c: c.forced), narrowed(F.concat(rest(s, i), F.transform(of_side(i), lambda c: c.sub))))))
    full = at.let(F.filter(subs, lambda s, i: F.get(outline, i).spoken > 0))
    good = whole(raw, ["open"], ["close"]) & named_at_all & chosen_well & native & stands & (F.size(full) > 0)
    return at.done(F.when(good, reading("black_african_american", agreed(full, W.BLACK_REGIONS))))


READERS = {"mena_label": mena, "aian_label": native_american, "nhpi_label": pacific, "uk_census_label": census, "european_label": european, "asian_label": asian, "black_label": black}


def with_readings(df: DataFrame, text: str) -> DataFrame:
    """Adds a struct<category, subcategory> for each reader, null where it does not read the text. The expressions are made once in a process."""
    names, made = df.columns, [reader(text, name) for name, reader in READERS.items()]
    for step in range(max(map(len, made))):  # a step of every reading at once
        df = df.withColumns(dict(steps[step] for steps in made if step < len(steps)))
    return df.select(*names, *READERS)
