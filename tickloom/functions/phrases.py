"""Terms of one or more words, found in texts as whole words through an index instead of a pattern each."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD, NOT_A_WORD = r"[\p{L}\p{N}_]+", r"[^\p{L}\p{N}_]+"
_WHOLE = re.compile(r"\w(.*\w)?", re.DOTALL)
#: Numbers that are added up at once where sums of a long array are asked for again and again.
SUM_BLOCK = 32
_MENTION = "array<struct<start:int,length:int,term:string,value:string>>"


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, even where `body` uses it many times.

    Short-circuit conditions are not covered by common-subexpression elimination.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def holds_phrase(lowered: Column, phrase: str) -> Column:
    """Whole-word match of any term; the substring test spares most texts the regex."""
    bounded = r"(?<![\p{L}\p{N}_])" + re.escape(phrase) + r"(?![\p{L}\p{N}_])"
    return F.contains(lowered, F.lit(phrase)) & F.rlike(lowered, F.lit(bounded))


def _strings(items: Iterable[str]) -> Column:
    return F.array(*map(F.lit, items)).cast("array<string>")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, x: total + x)


def _with_sums(numbers: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """`body` of a function that gives the sum of the first m numbers, for any m up to their count.

    It adds up what is left over of sums of SUM_BLOCK numbers and of SUM_BLOCK such sums, so that many sums of a long
    array take time in proportion to the array.
    """
    n = SUM_BLOCK

    def by_blocks(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / n).cast("int")), lambda b: _total(F.slice(xs, b * n + 1, F.lit(n))))

    def summed(ones: Column, blocks: Column, squares: Column) -> Column:
        def before(m: Column) -> Column:
            block, square = F.floor(m / n).cast("int"), F.floor(m / (n * n)).cast("int")
            parts = [(squares, F.lit(0), square), (blocks, square * n, block), (ones, block * n, m)]
            return sum((_total(F.slice(xs, start + 1, end - start)) for xs, start, end in parts), F.lit(0))

        return body(before)

    return once(numbers, lambda ones: once(by_blocks(ones), lambda blocks: once(by_blocks(blocks), lambda squares: summed(ones, blocks, squares))))


class PhraseIndex:
    """Terms with a value each, by first word.

    A text is cut into words once. Terms of one word are looked up among them; of a longer term first its longest word,
    which few texts have. Only where all its words are there, the windows that start with its first word are compared,
    words and what stands between them ("market  cap" is not "market cap"). All methods take the lower-cased text; a NULL
    text gives NULL. An empty term matches nothing; a term that begins or ends with a sign has no words to look up there
    and is searched as a pattern.
    """

    def __init__(self, terms: Mapping[str, str]):
        self.values = {t.lower(): v for t, v in terms.items() if t}
        parts = {t: re.findall(r"\w+", t) for t in self.values if _WHOLE.fullmatch(t)}
        self.single = {t: self.values[t] for t, w in parts.items() if len(w) == 1}
        self.longer = {t: w for t, w in parts.items() if len(w) > 1}
        self.signs = {t: v for t, v in self.values.items() if t not in parts}
        self._parts = parts

    def _by_first_word(self, terms: Iterable[str]) -> Column:
        """first word -> terms with their words, gaps and values."""
        grouped: dict[str, list[Column]] = {}
        for t in terms:
            words = self._parts[t]
            entry = F.struct(
                F.lit(t).alias("term"), F.lit(self.values[t]).alias("value"), _strings(words).alias("words"),
                _strings(re.split(r"\w+", t)[1:-1]).alias("gaps"),
            )
            grouped.setdefault(words[0], []).append(entry)
        return F.create_map(*[x for first, entries in grouped.items() for x in (F.lit(first), F.array(*entries))])

    @staticmethod
    def _words(lowered: Column) -> Column:
        """Words after an empty first item, whatever the text begins with."""
        return F.split(F.concat(F.lit(" "), lowered), NOT_A_WORD)

    @staticmethod
    def _gaps(lowered: Column) -> Column:
        """What follows each item of the words: item k stands between the k-th word and the next."""
        return F.split(F.concat(F.lit(" "), lowered), WORD)

    @staticmethod
    def _stands(words: Column, gaps: Column, place: Column, entry: Column) -> Column:
        """The window from `place` is the term."""
        n = F.size(entry["words"])
        return (F.slice(words, place, n) == entry["words"]) & (F.slice(gaps, place, n - 1) == entry["gaps"])

    def _found_longer(self, lowered: Column, words: Column) -> Column:
        """Entries of the terms of several words that the text holds."""
        index = self._by_first_word(self.longer)
        none = F.slice(F.flatten(F.map_values(index)), 1, 0)
        longest = sorted({max(w, key=len) for w in self.longer.values()})
        known = F.array_intersect(words, _strings(sorted({x for w in self.longer.values() for x in w})))

        def likely(known: Column) -> Column:
            firsts = F.array_intersect(known, F.map_keys(index))
            entries = F.flatten(F.transform(firsts, lambda f: F.element_at(index, f)))
            return F.filter(entries, lambda e: F.size(F.array_except(e["words"], known)) == 0)

        def compared(entries: Column) -> Column:
            return once(
                self._gaps(lowered),
                lambda gaps: F.filter(
                    entries,
                    lambda e: F.exists(
                        F.sequence(F.lit(1), F.size(words)),
                        lambda k: (F.get(words, k - 1) == F.get(e["words"], F.lit(0))) & self._stands(words, gaps, k, e),
                    ),
                ),
            )

        found = once(once(known, likely), lambda entries: F.when(F.size(entries) > 0, compared(entries)).otherwise(entries))
        return F.when(F.arrays_overlap(words, _strings(longest)), found).otherwise(none)

    def holds(self, lowered: Column) -> Column:
        """Whether the text holds any term."""

        def hit(w: Column) -> Column:
            found = F.arrays_overlap(w, _strings(self.single)) if self.single else F.size(w) < 0
            return found | (F.size(self._found_longer(lowered, w)) > 0) if self.longer else found

        found = once(self._words(lowered), hit)
        for t in self.signs:
            found = found | holds_phrase(lowered, t)
        return found

    def found(self, lowered: Column) -> Column:
        """Sorted distinct values of the terms that the text holds."""

        def values(w: Column) -> Column:
            parts = []
            if self.single:
                table = F.create_map(*[F.lit(v) for pair in self.single.items() for v in pair])
                hits = F.array_intersect(w, _strings(self.single))
                parts.append(F.transform(hits, lambda t: F.element_at(table, t)))
            if self.longer:
                parts.append(F.transform(self._found_longer(lowered, w), lambda e: e["value"]))
            return F.concat(*parts) if parts else _strings([])

        patterns = [F.when(holds_phrase(lowered, t), v) for t, v in self.signs.items()]
        words = once(self._words(lowered), values)
        every = F.concat(words, F.array_compact(F.array(*patterns))) if patterns else words
        return F.array_sort(F.array_distinct(every))

    def mentions(self, lowered: Column) -> Column:
        """Every occurrence of every term: start (characters from 0) and length in the lower-cased text, term, value; by start and term.

        Occurrences may overlap. Terms that begin or end with a sign have no place among the words and raise ValueError.
        """
        if self.signs:
            raise ValueError(f"terms must begin and end with a letter, digit or underscore: {sorted(self.signs)}")
        if not self._parts:
            return F.when(lowered.isNotNull(), F.array().cast(_MENTION))
        index = self._by_first_word(sorted(self._parts, key=len))  # as they stand at one place, so nothing is left to sort
        firsts = sorted({w[0] for w in self._parts.values()})

        def located(words: Column, gaps: Column) -> Column:
            lengths = F.zip_with(words, gaps, lambda w, g: F.length(w) + F.coalesce(F.length(g), F.lit(0)))
            places = F.filter(F.sequence(F.lit(1), F.size(words)), lambda k: F.get(words, k - 1).isin(firsts))

            def here(k: Column, before: Callable[[Column], Column]) -> Column:
                terms = F.filter(F.element_at(index, F.get(words, k - 1)), lambda e: self._stands(words, gaps, k, e))
                return once(
                    before(k - 1) - 1,
                    lambda start: F.transform(
                        terms, lambda e: F.struct(start.alias("start"), F.length(e["term"]).alias("length"), e["term"].alias("term"), e["value"].alias("value"))
                    ),
                )

            return _with_sums(lengths, lambda before: F.flatten(F.transform(places, lambda k: here(k, before)))).cast(_MENTION)

        def cut(words: Column) -> Column:
            found = once(self._gaps(lowered), lambda gaps: located(words, gaps))
            return F.when(F.arrays_overlap(words, _strings(firsts)), found).otherwise(F.array().cast(_MENTION))

        return F.when(lowered.isNotNull(), once(self._words(lowered), cut))
