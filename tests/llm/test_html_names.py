"""Names of sections inside articles and outside of them."""

import pytest

from tidemark.llm.html_extract import main_text

INSIDE = [
    ('<p class="share-price">The price rose.</p>', True),
    ('<p class="related-work">Others did so.</p>', True),
    ('<div class="notice-period">A month.</div>', True),
    ('<div class="share-price"><p>It fell.</p></div>', True),
    ("<header><h1>Headline</h1></header>", True),
    ('<div class="article-header"><h1>Headline</h1></div>', True),
    ('<h2 class="search">Searching</h2>', True),
    ('<div class="share">Share this</div>', False),
    ('<div class="share-buttons">Share this</div>', False),
    ('<section class="post-related related-posts-list">More</section>', False),
    ('<div id="comments"><p>First!</p></div>', False),
    ('<div class="ad ad-box-2">Buy</div>', False),
    ("<aside>Beside</aside>", False),
    ("<nav>Menu</nav>", False),
    ("<footer>Foot</footer>", False),
    ('<form><p>Name</p></form>', False),
]


@pytest.mark.parametrize("part, kept", INSIDE)
def test_sections_inside_an_article(part, kept):
    text = main_text(f"<body><header><p>Site</p></header><article><p>First.</p>{part}<p>Last.</p></article><footer>End</footer></body>").split("\n")
    assert text[0] == "First." and text[-1] == "Last." and (len(text) == 3) == kept and "Site" not in text


@pytest.mark.parametrize("part", ['<div class="share-price">1</div>', '<div class="page-header">2</div>', "<header>3</header>", '<p class="related-work">4</p>'])
def test_sections_outside_of_articles_go_by_their_names(part):
    assert main_text(f"<body>{part}<div><p>Text.</p></div></body>") == "Text."
