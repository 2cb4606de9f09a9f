"""Labelled pages: small pages of common layouts, written for this library, whose content is marked.

The attribute data-main marks an element whose text, with all below it, is main text; data-rest marks
an element inside it that is not. The marks are read as labels and are never seen as features.
"""

_LONG = "Rivers carry sand and gravel from the hills to the plain, and each flood leaves another thin layer behind. "
_MORE = "The town measured the water every spring, and the records show how the channel moved over the years. "
_SHORT = "See the map. "
_MENU = "<ul>" + "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("Home", "News", "Shop", "About", "Contact", "Help")) + "</ul>"
_LINKS = "".join(f'<a href="/s{i}">Story number {i}</a> ' for i in range(6))
_HEAD = '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>Rivers</title><style>p{margin:0}</style><script>var a=1;</script></head>'
_PARAGRAPHS = f"<p>{_LONG}{_MORE}{_LONG}</p><p>{_MORE}{_LONG}</p><p>{_SHORT}</p>"

PAGES = (
    f'{_HEAD}<body><nav>{_MENU}</nav><div class="ad">Buy new boots today.</div><article data-main><h1>Rivers</h1>{_PARAGRAPHS}</article><footer>&copy; site</footer></body></html>',
    f'{_HEAD}<body><header><a href="/">Site</a><nav>{_MENU}</nav></header><main data-main><h1>Rivers</h1>{_PARAGRAPHS}<h2>Floods</h2><ul><li>{_LONG}</li><li>{_MORE}</li></ul></main><aside><h3>Related</h3>{_LINKS}</aside><footer><p>Terms and privacy</p></footer></body></html>',
    f'{_HEAD}<body><div id="header"><a href="/">Site</a>{_MENU}</div><div id="content" data-main><h1>Rivers</h1>{_PARAGRAPHS}<blockquote><p>{_LONG}</p></blockquote></div><div id="sidebar"><h3>More</h3>{_MENU}</div><div id="footer">Copyright site</div></body></html>',
    f'{_HEAD}<body><div class="cookie-notice"><p>This site uses cookies. <button>Accept</button></p></div><div class="menu">{_MENU}</div><div class="post" data-main><h1>Rivers</h1><div class="entry-content">{_PARAGRAPHS}</div></div><div class="comments" id="comments"><h3>2 comments</h3><div class="comment"><p>{_MORE}</p></div><div class="comment"><p>{_LONG}</p></div><form><textarea>Reply</textarea><input type="submit"></form></div></body></html>',
    f'{_HEAD}<body><article data-main><header><h1>Rivers</h1></header>{_PARAGRAPHS}<div class="ad" data-rest>Cheap flights, book now.</div><p>{_LONG}</p><figure><img src="a.png"><figcaption>{_SHORT}</figcaption></figure><section class="comments" data-rest><h2>Comments</h2><p>{_MORE}</p></section><footer data-rest>Share this: <a href="/x">link</a></footer></article></body></html>',
    f'{_HEAD}<body><div class="wrapper"><div class="navbar">{_MENU}</div><div class="main"><div class="article-body" data-main><h1>Rivers</h1>{_PARAGRAPHS}<table><tr><th>Year</th><th>Level</th></tr><tr><td>1990</td><td>4.2</td></tr></table><pre>level = 4</pre></div><div class="related">{_LINKS}</div><div class="newsletter"><form><label>Your address</label><input><button>Join</button></form></div></div></div></body></html>',
    f'{_HEAD}<body><div role="navigation">{_MENU}</div><div role="main" data-main><h1>Rivers</h1>{_PARAGRAPHS}<p>{_LONG}<a href="/y">source</a></p></div><div role="complementary">{_LINKS}</div><div role="contentinfo">All rights reserved</div></body></html>',
    f'{_HEAD}<body><header><h1>Site name</h1>{_MENU}</header><section class="banner advert"><p>Save now on every order.</p></section><section class="story" data-main><h2>Rivers</h2>{_PARAGRAPHS}<ol><li>{_MORE}</li></ol><dl><dt>Silt</dt><dd>{_LONG}</dd></dl></section><section class="promo sponsored">{_LINKS}</section><footer>{_MENU}</footer></body></html>',
    f'{_HEAD}<body><article data-main><h1>Rivers</h1><p><b>Rivers.<br><p>{_LONG}</p><p>{_MORE}{_MORE}</p></article><aside class="sidebar"><div class="widget">{_MENU}</div></aside><footer>Imprint</footer></body></html>',
    f'{_HEAD}<body><div class="popup modal"><p>Subscribe to the letter.</p></div><div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/r">Rivers</a></div><article data-main><h1>Rivers</h1><p class="byline">By a writer</p>{_PARAGRAPHS}<div class="share social" data-rest>{_LINKS}</div></article><div class="disqus"><p>{_MORE}</p></div></body></html>',
    f'{_HEAD}<body><div class="notice"><p>{_SHORT}We use cookies to remember you.</p></div><article data-main><h1>Rivers</h1>{_PARAGRAPHS}</article><div id="comments"><h2>Comments</h2><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>{_MORE}{_LONG}</p></div><div class="comment"><p>{_MORE}</p></div></div><footer>Imprint</footer></body></html>',
    f'{_HEAD}<body><div class="alert"><p>The site is closed on Monday.</p></div><nav>{_MENU}</nav><main data-main><h1>Rivers</h1>{_PARAGRAPHS}</main><section class="comments"><h2>Readers</h2><p>{_MORE}</p><p>{_LONG}</p></section><form><p>Your comment</p><textarea>text</textarea></form></body></html>',
    f'{_HEAD}<body><header><p>{_SHORT}</p></header><article data-main><h1>Rivers</h1>{_PARAGRAPHS}<aside data-rest><h3>In short</h3><p>{_MORE}</p></aside><p>{_LONG}</p><nav data-rest>{_MENU}</nav></article><aside><p>{_MORE}</p><p>{_LONG}</p></aside><footer><p>{_MORE}</p></footer></body></html>',
    f'{_HEAD}<body><div class="cookie-banner"><p>This site stores cookies on your device.</p></div><div class="sponsor ads"><p>{_MORE}</p></div><article data-main><h1>Rivers</h1>{_PARAGRAPHS}<form data-rest><p>{_SHORT}</p><input></form></article><ul class="comment-list"><li class="comment"><p>{_LONG}</p></li><li class="comment reply"><p>{_MORE}</p></li></ul><div class="sidebar"><p>{_LONG}</p></div></body></html>',
    f'{_HEAD}<body><article data-main><h1>Rivers</h1><p>{_SHORT}</p></article><footer>&copy; site</footer></body></html>',
    f'{_HEAD}<body><div class="ad">{_MORE}</div><article data-main><h1>Rivers</h1><p>{_LONG}<a href="/z">source</a> {_MORE}</p><p>{_LONG}</p><div class="notice" data-rest><p>{_MORE}</p></div><div class="comments" data-rest><p>{_LONG}</p><p>{_MORE}</p></div></article><div class="footer"><p>{_MORE}</p></div><div class="header">Site</div></body></html>',
)
