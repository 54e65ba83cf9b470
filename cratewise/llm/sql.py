"""The queries of this package as SQL for a second engine, where SQL can express them."""

from __future__ import annotations

from cratewise.llm.licenses import SPELLINGS, catalogue

BLANK = r"[\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def exact_dedup() -> str:
    return f"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), {quoted(BLANK)}, ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM n WINDOW same AS (PARTITION BY text_sha256)"""


#: Words that make "copyright" part of a sentence, notices, headings, item numbers and named holders, for this engine's expressions.
SENTENCE = (
    r"(and|are|as|by|claim|claims|disclaimer|disclaimers|for|holder|holders|if|in|infringement|interest|interests|is|law|laws|licence|licences"
    r"|license|licenses|notice|notices|of|on|or|owner|owners|permission|protection|resulting|statement|statements|status|that|the library"
    r"|the program|the software|the work|to|treaty|under|with)\b"
)
NOTICE = r"(?m)^[^a-z0-9\n]*((portions )?copyright([ \t:]+[^\s]|©)|\(c\)[ \t]*(copyright|\d|<|\[|\{)|©|all rights reserved)[^\n]*$"
HEADING = (
    r"(?m)^[^a-z0-9\n]*(the )?((new|modified|revised|simplified) )?(mit|isc|zlib|expat|bsd|0bsd)([ -](\d|zero)[ -]clause)?"
    r"( [\x22'(]?(simplified|new|revised|modified)[\x22')]?)? licen[cs]e( \([^)\n]*\))?[^a-z0-9\n]*$"
)
NAMED = {
    r"\bneither the name(s)? of ([^ ]+ ){1,12}nor the name(s)? of ((any|its|his|her|their) )?contributors": "neither the name of the holder nor the names of contributors",
    r"\bsoftware is provided by ([^ ]+ ){1,12}as is\b": "software is provided by the holder as is",
    r"\bin no event shall ([^ ]+ ){1,12}be liable\b": "in no event shall the holder be liable",
    r"\bas is and ([^ ]+ ){1,12}disclaim(s)? all\b": "as is and the holder disclaims all",
    r"\b(51 franklin (st|street) fifth floor|59 temple place suite 330|675 mass ave) (boston|cambridge) ma \d{5}( \d{4})?( usa)?\b": "",
}


def canonical(text: str) -> str:
    """The canonical form of a licence text, as the operator defines it."""
    out = f"regexp_replace(lower(coalesce({text}, '')), {quoted(chr(92) + 'r' + chr(92) + 'n?')}, chr(10), 'g')"
    out = f"regexp_replace({out}, {quoted('copyright[ ' + chr(92) + 't]+' + SENTENCE)}, {quoted('copyright-' + chr(92) + '1')}, 'g')"
    for line in (HEADING, NOTICE, r"(?m)^[^a-z0-9\n]*\d\d?\.[ \t]+|\(\d\d?\)"):
        out = f"regexp_replace({out}, {quoted(line)}, '', 'g')"
    out = f"trim(regexp_replace({out}, {quoted('[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]+')}, ' ', 'g'))"
    for spelling, one in SPELLINGS:
        out = f"trim(replace(concat(' ', {out}, ' '), ' {spelling} ', ' {one} '))"
    for named, one in NAMED.items():
        out = f"regexp_replace({out}, {quoted(named)}, {quoted(one)}, 'g')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def license_scan() -> str:
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in catalogue())
    return f"""
        WITH known AS (SELECT sha256({canonical("t")}) AS digest, min(name) AS license FROM (VALUES {known}) AS l(name, t) GROUP BY 1),
             seen AS (SELECT doc_id, sha256({canonical("text")}) AS digest FROM documents)
        SELECT doc_id, digest, license FROM seen LEFT JOIN known USING (digest)"""


#: Fixed value: a term of the lexical search, after A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def search() -> str:
    """Every score of every item and document that share a term, ranked."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    terms = f"unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), {quoted(TERM)})) AS term"
    return f"""
        WITH t AS (SELECT doc_id, {terms} FROM documents),
             d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
             g AS (SELECT count(*) AS docs, sum(n) AS words FROM d),
             m AS (SELECT doc_id, 25 + (75 * n * docs) // words AS m FROM d, g),
             q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {terms} FROM benchmark) GROUP BY ALL),
             tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
             w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
                   FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), g),
             s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
                   FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
             r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
                   FROM s WHERE score > 0)
        SELECT * FROM r WHERE rank <= 10"""


def filter_audit() -> str:
    """Every order of the filters over the table of failed filters; shares as sums over all orders."""
    letters = "(SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b)"
    steps = [f"SELECT o, {i} AS step, p{i} AS own, {'+'.join(['0', *[f'p{j}' for j in range(1, i)]])} AS before FROM orders" for i in range(1, 6)]
    pairs = [(i, j) for i in range(1, 6) for j in range(i + 1, 6)]
    return f"""
        WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), {quoted("[^" + BLANK[1:])}) AS words FROM documents),
             l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
             f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                          CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
                          + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                          + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
                          + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                          + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails
                   FROM w LEFT JOIN l USING (doc_id)),
             cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
             orders AS (SELECT {"||".join(f"l{i}.l" for i in range(1, 6))} AS o, {", ".join(f"l{i}.b AS p{i}" for i in range(1, 6))}
                        FROM {", ".join(f"{letters} AS l{i}" for i in range(1, 6))} WHERE {" AND ".join(f"l{i}.b <> l{j}.b" for i, j in pairs)}),
             steps AS ({" UNION ALL ".join(steps)}),
             found AS (SELECT part, o, step, own,
                              sum(n) FILTER (fails & (before | own) = 0) AS kept,
                              sum(n) FILTER (fails & before = 0 AND fails & own <> 0) AS removed,
                              sum(n) FILTER (fails & before <> 0 AND fails & own <> 0) AS redundant,
                              sum(n) FILTER (fails = own) AS unique_fails,
                              sum(good) FILTER (fails & before = 0 AND fails & own <> 0) AS good_lost,
                              sum(toxic) FILTER (fails & before = 0 AND fails & own <> 0) AS toxic_lost
                       FROM cells, steps GROUP BY part, o, step, own)
        SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step,
               {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
               CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
        FROM found"""


SQL: dict[str, str] = {
    "op2_license_scan": license_scan(),
    "op4_exact_dedup": exact_dedup(),
    "op11_search": search(),
    "op12_filter_audit": filter_audit(),
}
