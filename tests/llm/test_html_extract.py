import numpy as np
import pytest

from termsim.llm import html_extract as he

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav><div class="ad">Buy now {k}</div>
<article><h1>Head {k}</h1><p>First &amp; foremost {k} <b>bold</b>
 text.<p>Second paragraph {k}<br>goes on &eacute;.</article><div class="comments"><p>Nice read {k}!</p></div>
<footer>&copy; site {k}</footer></body></html>"""


def texts(page):
    return [b.text for b in he.blocks(page)]


@pytest.mark.parametrize(
    "page,expected",
    [
        ("", []), ("<", ["<"]), ("<!--", []), ("plain &lt;b&gt; text", ["plain <b> text"]), ("<script>x", []), ("a<!-- x > y -->b", ["ab"]),
        ("<article>a<script>if(a<b)</script>b<p>c", ["ab", "c"]), ("<p>a<svg><path d='x'/><text>no</text></svg>b</p>c", ["ab", "c"]),
        ("<div hidden>x<p>y</p></div>z", ["z"]), ("<ul><li>a<li>b</ul>", ["a", "b"]), ("<p><b>T<br><p>U</p>V", ["T", "U", "V"]),
        ("<textarea><p>x</textarea>y", ["y"]), ('<a href="x>y">l</a>', ["l"]), ("<table><tr><td>1<td>2</table>", ["1", "2"]),
        ("<p> a \n\t b&nbsp;c </p>", ["a b c"]), ("</p></div>x", ["x"]), ("<p>" * 3000 + "deep", ["deep"]),
    ],
)
def test_blocks(page, expected):
    assert texts(page) == expected


def test_roles():
    found = {b.text: he.role_label(b) for b in he.blocks(PAGE.format(k=1))}
    assert found == {
        "Menu one": 0, "Menu two": 0, "Buy now 1": 0, "Head 1": 1, "First & foremost 1 bold text.": 1,
        "Second paragraph 1 goes on é.": 1, "Nice read 1!": 0, "© site 1": 0,
    }


def test_gradient():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in he.new_weights(1).items()}
    pages = [rng.normal(size=(n, he.INPUT)) for n in (5, 2)]
    x, mask = he._padded([p.astype(np.float32) for p in pages])
    y = (rng.random(mask.shape) < 0.5) * mask

    def loss():
        p = he._forward(w, x, mask)[0]
        return float(-(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum())

    p, both, kept_f, kept_b = he._forward(w, x, mask)
    d = ((p - y) * mask / mask.sum())[:, :, None] @ w["o"].T
    grads = dict(zip(("xf", "hf", "cf"), he._lstm_back(d[:, :, : he.HIDDEN], x, kept_f, w["xf"], w["hf"])))
    grads |= dict(zip(("xb", "hb", "cb"), he._lstm_back(d[:, ::-1, he.HIDDEN :], x[:, ::-1], kept_b, w["xb"], w["hb"])))
    for key, g in grads.items():
        flat = w[key].reshape(-1)
        for at in rng.integers(0, flat.size, 4):
            old, e = flat[at], 1e-3
            flat[at] = old + e
            up = loss()
            flat[at] = old - e
            down = loss()
            flat[at] = old
            assert abs((up - down) / (2 * e) - g.reshape(-1)[at]) < 2e-3


def test_padding_does_not_change_a_page():
    w = he.new_weights(3)
    page = he.blocks(PAGE.format(k=1))
    longer = he.blocks(PAGE.format(k=2) * 5)
    alone = he.label_pages(w, [page])[0]
    beside = he.label_pages(w, [page, longer, []])
    assert np.allclose(alone, beside[0], atol=1e-6) and len(beside[2]) == 0


@pytest.fixture(scope="module")
def model():
    x, y = he.training_pages([PAGE.format(k=k) for k in range(40)])
    return he.train(x, y)


def test_learnt_labels_on_other_pages(model):
    rng = np.random.default_rng(9)
    wrong = total = 0
    for k in range(40, 80):
        page, labels = he.variant(he.blocks(PAGE.format(k=k)), rng)
        p = he.label_pages(model, [page])[0]
        wrong += int(((p >= 0.5) != np.array(labels)).sum())
        total += len(labels)
    assert wrong < 0.06 * total


def test_spark(spark, model):
    rows = [(k, f"u{k}", PAGE.format(k=k), "x") for k in range(30)] + [(50, None, None, "x"), (None, "u", "", "x"), (51, "u", "<p>", "x"), (3, "u3", PAGE.format(k=3), "x")]
    rows.append((52, "u", "<html><body><article>" + "<p>word</p>" * 3000 + "</article></body></html>", "x"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r["page_id"], r["url"]): r for r in he.extract(pages, model).collect()}
    assert he.extract(pages, model).count() == len(rows)
    for k in range(30):
        assert got[k, f"u{k}"]["text"] == f"Head {k}\nFirst & foremost {k} bold text.\nSecond paragraph {k} goes on é."
    assert got[50, None]["text"] == got[None, "u"]["text"] == got[51, "u"]["text"] == ""
    assert got[52, "u"]["text"].count("word") > 2990
    none = pages.where("page_id < 0")
    assert he.fit(none) is None and he.extract(none, None).collect() == []
    assert he.extract(pages.where("page_id = 1"), None).first()["text"].startswith("Head 1\n")
