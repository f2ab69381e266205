import pytest

from sorterlog.llm import pages


def words(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


@pytest.fixture(scope="module")
def model(spark):
    """Weights learnt from pages that all have one article, with lists and blocks outside only."""
    page = f"<html><body><div><ul><li><a href=x>link</a></ul></div><article><h1>head</h1><p>{words('w', 50)}</p></article><div><p>after</p></div></body></html>"
    found = pages.fit(spark.createDataFrame([(i, page) for i in range(300)], "page_id long, html string"))
    assert found.tag["/article"] == -pages.WORDS
    return found


A, B = words("a", 150), words("b", 90)


@pytest.mark.parametrize("page, want", [
    (f"<body><div class='layout has-sidebar'><article><p>{A}</p></article></div></body>", A),
    (f"<body><div class='page no-sidebar'><div class='inner'><article><p>{A}</p></article></div></div></body>", A),
    (f"<body><div class='content-with-comments'><p>{A}</p></div></body>", A),
    (f"<body><div class='widget'><article><p>{A}</p></article></div></body>", A),
    (f"<body><div class='widget'><nav>menu</nav><article><p>{A}</p></article></div></body>", A),
    (f"<body><form><article><p>{A}</p></article></form></body>", A),
    (f"<body><div class='sidebar'><article><p>{B}</p></article></div><section><p>{A}</p></section></body>", A),
    (f"<body><div class='comments'><article><p>{B}</p></article></div></body>", ""),
    (f"<body><div class='promo'><aside><article><p>{B}</p></article></aside></div></body>", ""),
    (f"<body><article><p>{A}</p></article><article><p>{B}</p></article></body>", f"{A} {B}"),
    (f"<body><div><article><p>{B}</p></article></div><div><article><p>{A}</p></article></div></body>", f"{B} {A}"),
    (f"<body><section><p>{A}</p></section></body>", A),
    (f"<body><article class='post comment-enabled'><p>{A}</p></article></body>", A),
    (f"<body><div class='post comments-open'><p>{A}</p></div></body>", A),
    (f"<body><div class='row sidebar-right'><p>{A}</p></div></body>", A),
    (f"<body><form id='aspnetForm' action='x'><input name=q><label>Search</label><p>{A}</p></form></body>", A),
    (f"<body><p>{A}</p><form action='x'><label>Mail</label><p>sign up for news</p><input name=q></form></body>", A),
    (f"<body><article><p>{A}</p><p class='share-price'>{B}</p></article></body>", f"{A} {B}"),
    (f"<body><article><section id='search-algorithms'><p>{A}</p></section></article></body>", A),
    (f"<body><article><p>{A}</p><div id='notice-period'><p>{B}</p></div></article></body>", f"{A} {B}"),
    (f"<body><article><p>{A}</p></article><ul id='comment-list'><li id='comment-12'>nice one</ul><div class='site-footer'>foot</div><div class='cookie-banner'>eat</div></body>", A),
    ("<body><article>" + "".join(f"<section><h2>題{i}</h2><p>{'字' * 165}</p></section>" for i in range(5)) + "</article></body>", " ".join(f"題{i} {'字' * 165}" for i in range(5))),
    ("<body><article><ul>" + "".join(f"<li>item number{i}" for i in range(60)) + f"</ul><p>{B}</p></article></body>", " ".join(f"item number{i}" for i in range(60)) + f" {B}"),
    ("<body><article><dl>" + "".join(f"<dt>term{i}<dd>its meaning{i}" for i in range(40)) + f"</dl><p>{B}</p></article></body>", " ".join(f"term{i} its meaning{i}" for i in range(40)) + f" {B}"),
    (f"<body><article><figure><img src=x><figcaption>what it shows</figcaption></figure><p>{A}</p></article></body>", f"what it shows {A}"),
    (f"<body><article><p>{words('t', 5)}</p></article><div class='post'><p>{A}</p><p>{B}</p></div></body>", f"{A} {B}"),
])
def test_layouts_with_learnt_weights(model, page, want):
    assert pages.main_text(page, model) == want
