"""SQL pieces that Spark and DuckDB write differently, so that one text of a query serves both."""

from __future__ import annotations


class Spark:
    name = "spark"

    @staticmethod
    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    @staticmethod
    def re(pattern: str) -> str:
        return f"r'{pattern}'"

    def sub(self, x: str, pattern: str, new: str) -> str:
        return f"regexp_replace({x}, {self.re(pattern)}, {self.text(new)})"

    def find(self, x: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({x}, {self.re(pattern)}, {group})"

    def find_all(self, x: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract_all({x}, {self.re(pattern)}, {group})"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_like({x}, {self.re(pattern)})"

    def join(self, items: str, by: str) -> str:
        return f"array_join({items}, {self.text(by)})"

    def first_of(self, items: list[str], n: int) -> str:
        return f"slice(array_compact(array({', '.join(items)})), 1, {n})"

    def split(self, x: str, by: str) -> str:
        return f"split({x}, {self.re(by)})"

    def keep(self, items: str, test: str) -> str:
        return f"filter({items}, x -> {test})"

    def exploded(self, table: str, items: str, at: str, item: str, columns: str = "*") -> str:
        return f"(SELECT {columns}, pos + 1 AS {at}, col AS {item} FROM (SELECT *, posexplode({items}) FROM {table}))"

    def tagged(self, table: str, arrays: list[str]) -> str:
        """page_id, pattern (which of the arrays, from 0), nth, token of each item of the arrays, in one pass."""
        items = ", ".join(f"transform({a}, (x, i) -> named_struct('pattern', {k}, 'nth', i + 1, 'token', x))" for k, a in enumerate(arrays))
        return f"(SELECT page_id, t.pattern, t.nth, t.token FROM (SELECT page_id, explode(concat({items})) AS t FROM {table}))"

    def without_dots(self, path: str) -> str:
        """A path without its . and .. segments: a fold with a stack that keeps the root."""
        kept = f"aggregate(split({path}, '/'), CAST(array() AS ARRAY<STRING>), (s, p) -> CASE WHEN p = '..' THEN slice(s, 1, greatest(size(s) - 1, 1)) WHEN p = '.' THEN s ELSE concat(s, array(p)) END)"
        return f"array_join({kept}, '/')"

    def md5(self, x: str) -> str:
        return f"md5({x})"

    @staticmethod
    def back(group: int) -> str:
        return f"${group}"

    def last_part(self, x: str, by: str) -> str:
        return f"substring_index({x}, {self.text(by)}, -1)"

    def first_part(self, x: str, by: str) -> str:
        return f"substring_index({x}, {self.text(by)}, 1)"

    @staticmethod
    def numbered(x: str) -> str:
        return f"format_string('example_%04d', {x})"

    @staticmethod
    def div(a: str, b: str) -> str:
        return f"({a}) div ({b})"

    def each(self, items: str, value: str) -> str:
        return f"transform({items}, x -> {value})"

    def map_of(self, pairs: str, entry: str, pair: str) -> str:
        return f"str_to_map({self.text(pairs)}, {self.text(entry)}, {self.text(pair)})"

    def at(self, table: str, key: str) -> str:
        return f"try_element_at({table}, {key})"

    def number(self, x: str) -> str:
        return f"try_cast({x} AS BIGINT)"

    def hex_number(self, x: str) -> str:
        return f"try_cast(conv(nullif({x}, ''), 16, 10) AS BIGINT)"

    def character(self, n: str) -> str:
        return f"decode(unhex(lpad(hex({n}), 8, '0')), 'UTF-32')"


class Duck(Spark):
    name = "duckdb"

    @staticmethod
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    @staticmethod
    def re(pattern: str) -> str:
        return f"'{pattern}'"

    def sub(self, x: str, pattern: str, new: str) -> str:
        return f"regexp_replace({x}, {self.re(pattern)}, {self.text(new)}, 'g')"

    def matches(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {self.re(pattern)})"

    def join(self, items: str, by: str) -> str:
        return f"array_to_string({items}, {self.text(by)})"

    def first_of(self, items: list[str], n: int) -> str:
        return f"list_slice(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL), 1, {n})"

    def split(self, x: str, by: str) -> str:
        return f"regexp_split_to_array({x}, {self.re(by)})"

    def keep(self, items: str, test: str) -> str:
        return f"list_filter({items}, lambda x: {test})"

    def exploded(self, table: str, items: str, at: str, item: str, columns: str = "*") -> str:
        return f"(SELECT {columns}, unnest(range(1, len({items}) + 1)) AS {at}, unnest({items}) AS {item} FROM {table})"

    def tagged(self, table: str, arrays: list[str]) -> str:
        return "(" + " UNION ALL ".join(f"SELECT page_id, {k} AS pattern, nth, token FROM {self.exploded(table, a, 'nth', 'token', 'page_id')} t" for k, a in enumerate(arrays)) + ")"

    def without_dots(self, path: str) -> str:
        kept = f"list_reduce(list_transform(string_split({path}, '/'), lambda x: [x]), lambda s, p: CASE WHEN p[1] = '..' THEN list_slice(s, 1, greatest(len(s) - 1, 1)) WHEN p[1] = '.' THEN s ELSE list_concat(s, p) END)"
        return f"array_to_string({kept}, '/')"

    @staticmethod
    def back(group: int) -> str:
        return f"\\{group}"

    def last_part(self, x: str, by: str) -> str:
        return f"split_part({x}, {self.text(by)}, -1)"

    def first_part(self, x: str, by: str) -> str:
        return f"split_part({x}, {self.text(by)}, 1)"

    @staticmethod
    def numbered(x: str) -> str:
        return f"printf('example_%04d', {x})"

    @staticmethod
    def div(a: str, b: str) -> str:
        return f"({a}) // ({b})"

    def each(self, items: str, value: str) -> str:
        return f"list_transform({items}, lambda x: {value})"

    def map_of(self, pairs: str, entry: str, pair: str) -> str:
        return f"map_from_entries(list_transform(string_split({self.text(pairs)}, {self.text(entry)}), lambda e: (split_part(e, {self.text(pair)}, 1), split_part(e, {self.text(pair)}, 2))))"

    def at(self, table: str, key: str) -> str:
        return f"{table}[{key}]"

    def hex_number(self, x: str) -> str:
        return f"try_cast('0x' || nullif({x}, '') AS BIGINT)"

    def character(self, n: str) -> str:
        return f"chr(CAST({n} AS INT))"


def any_of(x: str, words: tuple[str, ...] | list[str]) -> str:
    return "(" + " OR ".join("contains({}, '{}')".format(x, w.replace("'", "''")) for w in words) + ")"


def times(x: str, word: str) -> str:
    """How often a word occurs, without overlaps."""
    return f"CAST((length({x}) - length(replace({x}, '{word}', ''))) / {len(word)} AS BIGINT)"


def strip(d: Spark, x: str) -> str:
    return d.sub(x, r"^\s+|\s+$", "")


def choose(cases: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{value}'" for test, value in cases) + f" ELSE {default} END"
