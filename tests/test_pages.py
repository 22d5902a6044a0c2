"""HTML outline: tree rules, labels, nested tables, round trips."""

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from schemaward.functions.html import BLOCK_TAGS, HIDDEN_TAGS, VOID_TAGS, PageOutline
from schemaward.operators import pages


class _Tree(HTMLParser):
    """Plain tree built by the standard tokenizer, to compare with."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = ("", [])
        self.stack = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = (tag, [])
        self.stack[-1][1].append(node)
        if tag not in VOID_TAGS:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if any(n[0] == tag for n in self.stack[1:]):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def _all(node, *tags):
    for child in node[1]:
        if not isinstance(child, str):
            if child[0] in tags:
                yield child
            yield from _all(child, *tags)


def _texts(node):
    for child in node[1]:
        if isinstance(child, str):
            if child.strip():
                yield child.strip().replace("\xa0", " ")
        elif child[0] not in HIDDEN_TAGS:
            yield from _texts(child)


def _cells(html):
    tree = _Tree(html).root
    return [[[" ".join(_texts(c)).strip() for c in _all(r, "td", "th")] for r in _all(t, "tr")] for t in _all(tree, "table")]


_pieces = st.lists(st.sampled_from([
    "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th a='>'>", "</th>", "a &amp; b", " x ", "<br>", "<b>", "</b>", "<p>", "</p>",
    "<div class=\"q\">", "</div>", "<td/>", "&nbsp;", "<script>if (a<b) '</td>'</script>", "<style>td{}</style>", "<tbody>", "1 < 2"]), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(_pieces)
def test_outline_equals_tree(html):
    page = PageOutline(html)
    assert [[[page.text(c) for c in r] for r in t] for t in page.tables] == _cells(html)
    assert [page.text(b) for b in page.blocks] == [" ".join(_texts(b)).strip() for b in _all(_Tree(html).root, *BLOCK_TAGS)]


def test_label_prefers_outer_block():
    page = PageOutline("<div>x <p>Table name: <b>T1</b></p> tail</div><p>Schema name: S</p>")
    assert page.labelled(["Table name:", "Schema name:", "Database name:"]) == {
        "Table name:": "x Table name: T1 tail", "Schema name:": "Schema name: S"}


def test_nested_tables_and_awkward_rows(spark):
    html = ("<table></table><table><tr><th>Name</th><th>Is PK?</th><th>Deprecated</th></tr>"
            "<tr><td>a</td><td><table><tr><td>in</td></tr></table></td></tr><tr><th>x</th><td>y</td></tr><tr><td> </td></tr></table>")
    cells = pages.page_tables(spark.createDataFrame([(1, html)], "page_id long, html string"))
    rows = {(r.table_ord, r.row_ord, r.key): r.value for r in cells.collect()}
    assert rows == {
        (2, 1, "name"): "a", (2, 1, "is_pk"): "in", (2, 1, "deprecated"): "false",  # the nested cell follows, too
        (2, 2, "name"): "in", (2, 2, "is_pk"): "", (2, 2, "deprecated"): "false",
        (2, 3, "name"): "y", (2, 3, "is_pk"): "", (2, 3, "deprecated"): "false",
        (2, 4, "name"): "", (2, 4, "is_pk"): "", (2, 4, "deprecated"): "false",
    }
    kept = pages.drop_blank_rows(cells)
    assert {r.row_ord for r in kept.collect()} == {1, 2, 3}


def test_document(spark):
    html = ("<p>Table name: </p><p>Foreign Keys: x , ,y</p><table><tr><th>A b</th><th>A-b</th></tr><tr><td>1</td><td>false</td></tr>"
            "<tr><td></td></tr></table>")
    page = pages.parsed_pages(spark.createDataFrame([(7, "Table: Orders", html, "kept")], "page_id long, title string, html string, extra string")).first()
    assert page.extra == "kept" and page.page.metadata.table_name == "Orders"
    assert page.page.metadata.foreign_keys == ["x", "y"] and page.page.metadata.primary_keys == []
    assert [c for c in page.page.tables[0]["columns"]] == [{"a_b": "false"}]


def test_one_unreadable_page_does_not_end_the_job(monkeypatch):
    def outline(html):
        if html == "bad":
            raise ValueError("no outline")
        return [], []
    monkeypatch.setattr(pages, "_outline", outline)
    assert pages._safe_outline("good") == ([], [], None)
    assert pages._safe_outline("bad") == ([], [], "ValueError: no outline")


def test_repeated_headers_give_the_last_value(spark):
    cells = spark.createDataFrame([(1, 1, 1, k, key, v) for k, (key, v) in enumerate([("k", "a"), ("x", "b"), ("k", "c")])],
                                  "page_id long, table_ord int, row_ord int, col_ord int, key string, value string")
    assert pages.pivot_cells(cells).first().record == {"k": "c", "x": "b"}
    wide = pages.pivot_cells(cells, ["k", "x"]).first()
    assert (wide.k, wide.x) == ("c", "b")


def test_cells_cleaned_in_the_row_equal_those_cleaned_as_cells(spark):
    table = ("<table><tr><th>A</th><th>B</th><th>A</th><th>Primary Key</th></tr><tr><td>1</td><td>2</td><td>3</td><td>yes</td></tr>"
             "<tr><td></td><td> </td></tr><tr><td>x</td></tr><tr><td>1</td><td></td><td></td><td></td></tr></table><table><tr><th>Z</th></tr></table>")
    df = spark.createDataFrame([(1, table), (2, None), (3, "<p>none</p>"), (4, table + table)], "page_id long, html string")
    cells = pages.page_tables(df)
    rows = lambda d: sorted(map(tuple, d.select("page_id", "table_ord", "row_ord", "col_ord", "key", "value").collect()))
    once = pages.dedupe_headers(cells)
    assert rows(pages.page_tables(df, one_per_header=True)) == rows(once)
    assert rows(pages.page_tables(df, filled_rows=True)) == rows(pages.drop_blank_rows(cells))
    both = pages.page_tables(df, one_per_header=True, filled_rows=True)
    assert rows(both) == rows(pages.drop_blank_rows(once)) and len(rows(both)) < len(rows(once))
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
