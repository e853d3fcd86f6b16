"""Labelled pages: whole documents, written for this library, with their main text marked.

``<!--main-->`` and ``<!--/main-->`` enclose the main text, ``<!--other-->`` and ``<!--/other-->``
what stands within it and is no part of it. The marks are comments: they are no markup to a reader.
"""

from __future__ import annotations

P1 = "The river rose by nearly two metres overnight, and by the morning the lower meadows were under water, as they had been three years before."
P2 = "Nobody was hurt, the mayor said, but several cellars had to be pumped out, and the bridge at the mill will stay closed until its piers have been looked at by divers."
P3 = "Farmers had moved their animals to higher ground on Tuesday; most of them had read the gauges themselves and did not wait to be told."
P4 = "What remains is mud, a smell of oil, and the question of who pays for the new fences."
S1, S2 = "It took two days to dry.", "Nothing else was lost."
PARAGRAPHS, LONG, SHORT = (P1, P2, P3, P4), P2, S2

PAGES = [
    # A newspaper.
    f"""<!DOCTYPE html><html lang="en"><head><title>Flood - The Valley Post</title><style>p{{margin:0}}</style><script>var a="<p>";</script></head><body class="single has-sidebar">
<a class="skip-link" href="#c">Skip to content</a><div id="cookie-banner" class="cookie-consent notice"><p>We use cookies to make this site better. Read our policy.</p><button>Accept all</button></div>
<header class="site-header masthead" role="banner"><div class="logo"><a href="/">The Valley Post</a></div><nav class="main-nav"><ul class="menu"><li class="menu-item"><a href="/">Home</a></li><li class="menu-item"><a href="/sport">Sport</a></li><li class="menu-item"><a href="/jobs">Jobs</a></li></ul></nav><form class="search-form"><label>Search</label><input name="q"><button>Go</button></form></header>
<div class="breadcrumb breadcrumbs"><a href="/">Home</a> / <a href="/local">Local</a></div>
<main id="c"><!--main--><article class="post hentry"><header class="entry-header"><h1 class="entry-title">Water in the lower town</h1></header><div class="entry-content"><p>{P1}</p><p>{P2}</p>
<!--other--><div class="ad advertisement"><p>Advertisement: new boots at half price, only this week.</p></div><!--/other--><h2>What the farmers did</h2><p>{P3}</p><blockquote class="pull-quote"><p>We read the gauges ourselves.</p></blockquote><p>{P4}</p>
<!--other--><aside class="newsletter signup"><h3>Our letter</h3><p>Get the news by mail every morning.</p><form><input><button>Subscribe</button></form></aside><!--/other--><p>{S1}</p></div><!--other--><footer class="entry-meta"><span class="tags">Filed under <a>floods</a>, <a>town</a></span></footer><div class="share social-share"><a>Share</a><a>Tweet</a></div><!--/other--></article><!--/main-->
<section id="comments" class="comments-area"><h2 class="comments-title">Three comments</h2><ol class="comment-list"><li class="comment"><article class="comment-body"><footer class="comment-meta"><b>Ann</b> says</footer><p>I saw it from my window and I must say that it was higher than the paper has it here.</p></article></li><li class="comment"><article class="comment-body"><p>Same as always. Nobody learns.</p></article></li></ol><div class="comment-respond"><h3>Leave a reply</h3><form class="comment-form"><textarea></textarea></form></div></section></main>
<aside class="sidebar widget-area" role="complementary"><section class="widget"><h2 class="widget-title">Most read</h2><ul><li><a>Fire at the station, and no one knows why it began</a></li><li><a>New roof</a></li></ul></section><div class="widget sponsored"><p>Sponsored: a loan that suits you.</p></div></aside>
<footer class="site-footer" role="contentinfo"><p class="copyright">&copy; The Valley Post. All rights reserved.</p><ul class="footer-menu"><li><a>Imprint</a></li><li><a>Privacy</a></li></ul></footer></body></html>""",
    # A home page in plain old markup.
    f"""<html><head><title>My boat</title></head><body bgcolor="#ffffff"><center><font size="2"><a href="1.htm">Start</a> | <a href="2.htm">Photos</a> | <a href="3.htm">Guest book</a></font></center><hr>
<!--main--><h1>How I built my boat</h1><p>{P1}<p>{P3}<br>{S1}<p>{P4}<ul><li>Oak for the keel<li>Larch for the planks, which a friend sawed for me in his yard</ul><p>{P2}<!--/main--><hr><center><font size="1"><a href="mailto:me">Mail</a> | <a href="#top">Top</a></font></center></body></html>""",
    # A table layout.
    f"""<html><body><table width="100%"><tr><td class="topbar" colspan="2"><a>Index</a> <a>Map</a> <a>Help</a></td></tr><tr><td class="leftnav navigation"><a>Rooms</a><br><a>Prices</a><br><a>Way here</a></td><td class="content"><!--main--><h2>The house</h2><p>{P1}</p><p>{P2}</p><table><tr><th>Room</th><th>Price</th></tr><tr><td>Single</td><td>40</td></tr><tr><td>Double</td><td>65</td></tr></table><p>{P4}</p><!--/main--></td></tr><tr><td class="bottom copyright" colspan="2">Copyright by the house, all rights kept</td></tr></table></body></html>""",
    # A blog with its story in a div, and teasers in articles.
    f"""<html><body><div id="wrapper"><div id="header"><h1 class="site-title"><a>Notes</a></h1><p class="tagline">On weather and such things</p></div><div id="nav" class="navbar"><ul><li><a>About</a></li><li><a>Archive</a></li></ul></div>
<div id="content" class="story"><!--main--><h2 class="title">After the rain</h2><p>{P2}</p><p>{P3} <a href="x">A friend wrote more on it</a> and I agree.</p><p>{P1}</p><div class="figure"><img src="a.png"><p class="caption">The meadow in May.</p></div><p>{P4}</p><!--/main--></div>
<div class="related related-posts"><h3>You may also like</h3><article class="card teaser"><h4><a>Snow in April</a></h4><p>It fell all night and in the morning...</p></article><article class="card teaser"><h4><a>Wind</a></h4><p>Read how the mill lost a sail.</p></article></div>
<div class="pagination pager"><a>Older</a> <a>Newer</a></div><div id="sidebar" class="rail"><div class="box about"><h4>About me</h4><p>I write about the valley and its weather since 2004.</p></div><div class="box tagcloud"><a>rain</a> <a>snow</a></div></div><div id="footer"><p>Made by hand. <a>Contact</a></p></div></div></body></html>""",
    # Documentation.
    f"""<html><body><nav class="toc" id="toc"><ul><li><a>Install</a><ul><li><a>From source</a></li></ul></li><li><a>Use</a></li></ul></nav><main role="main" class="docs"><!--main--><h1>Installing</h1><p>{S1} {S2}</p><pre><code>make &amp;&amp; make install</code></pre><p>{P2}</p><h2>Options</h2><dl><dt>-v</dt><dd>Say more, which helps if something goes wrong in between.</dd><dt>-q</dt><dd>Say less.</dd></dl><div class="admonition tip"><p>Run it twice if in doubt.</p></div><table class="docutils"><tr><td>a</td><td>b</td></tr></table><ol><li>First this.</li><li>Then that.</li></ol><p>For details see <a>the manual</a> and <a>the list of options</a>.</p><!--/main--><div class="prev-next"><a>Previous</a><a>Next</a></div></main><footer><p>Last built yesterday with a small tool.</p></footer></body></html>""",
    # A shop's advice page.
    f"""<html><body><div class="promo-bar banner"><p>Free shipping on all orders over fifty!</p></div><header><nav role="navigation"><a>Tools</a><a>Paint</a><a>Sale</a></nav><div class="cart"><a>Your cart (0)</a></div><div class="login account"><a>Sign in</a></div></header>
<div class="modal popup overlay" id="newsletter-popup"><p>Ten per cent off your first order if you join our list today.</p><form><input><button>Join</button></form></div><section class="page-content"><!--main--><h1>How to paint a door</h1><p>{P3}</p><ul><li>A brush.</li><li>Two tins of paint, of which one is for the ground and the other for the top.</li></ul><p>{P1}</p><p><strong>Mind:</strong> {S2}</p><!--other--><div class="product-box sponsored promo"><h3>Our choice</h3><p>Brush No. 4 for just nine.</p><a>Buy now</a></div><!--/other--><p>{P4}</p><!--/main--></section><div class="reviews" id="reviews"><h3>Reviews</h3><div class="review"><p>Works as they say. I did two doors with it and a window.</p></div></div><div class="recommended"><h3>Others bought</h3><ul><li><a>Tin</a></li></ul></div><footer class="footer"><div class="payment"><p>We take cards.</p></div><p>Imprint, terms and conditions</p></footer></body></html>""",
    # Two articles, and something between them.
    f"""<html><body><header><a>Day book</a></header><!--main--><article><h2>Monday</h2><p>{P1}</p><p>{S1}</p></article><!--other--><div class="banner"><p>Support us with a small gift each month, if you can.</p></div><div><p>Between the days, a word from those who pay for this.</p></div><!--/other--><article><h2>Tuesday</h2><p>{P3}</p><p>{P2}</p></article><!--/main--><footer>Kept since 1999</footer></body></html>""",
    # A press release with a quote in a banner and a formula.
    f"""<html><body><div class="topnav menu"><ul><li><a>News</a></li><li><a>People</a></li></ul></div><div class="alert notice" role="alert"><p>The office is closed on Friday.</p></div><main class="content"><article><!--main--><h1>A new bridge</h1><p class="lead intro">{S2}</p><p>{P2}</p><p class="banner">It will stand for a hundred years, said the builder.</p><figure><img><figcaption>The bridge as drawn.</figcaption></figure><p>The load is <math><mi>q</mi><mo>=</mo><mn>5</mn></math> at most.</p><p>{P4}</p><!--/main--></article></main><div class="contact-box"><h3>Press contact</h3><p>Call us from nine to five.</p></div><div class="social follow"><ul><li><a>Follow us</a></li></ul></div><footer><nav><a>Legal</a></nav></footer></body></html>""",
    # A forum: the question is the text, and the replies are readers' comments.
    f"""<html><body><div class="forum-nav breadcrumbs"><a>Forum</a> &gt; <a>Boats</a></div><div class="post question" id="post-1"><!--main--><h1>Which wood for a keel?</h1><div class="post-body"><p>{P3}</p><p>{P1}</p></div><!--/main--></div><div class="replies answers" id="discussion"><div class="reply comment"><div class="user"><a>Bob</a></div><p>Oak, always oak, and well dried. I had mine lie for six years before I touched it at all.</p></div><div class="reply comment"><p>Larch will do.</p></div></div><form class="reply-form"><p>Write a reply</p><textarea></textarea></form><div id="bottom" class="footer"><p>Powered by some software</p></div></body></html>""",
    # Bare paragraphs.
    f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>".join(("<!--main-->", "<!--/main-->")),
    f"<!--main-->{P1} {P2}\n\n{P3}<!--/main-->",
    f"<html><head><title>T</title></head><body><!--main--><h1>On mud</h1><div><div><p>{P4}</p></div><div><p>{P1}</p><span>{S1}</span></div></div><!--/main--></body></html>",
    f"<html><body><!--main--><div class='text'>{P1}<br><br>{P2}<br><br>{P3}</div><!--/main--></body></html>",
    # An encyclopedia.
    f"""<html><body><div id="mw-head" class="noprint"><div id="search"><form><input></form></div><div class="tabs"><ul><li><a>Read</a></li><li><a>Edit</a></li><li><a>View history</a></li></ul></div></div><div id="content" class="body" role="main"><!--main--><h1 id="firstHeading">Mill</h1><div id="bodyContent"><p>A <b>mill</b> is a house with a wheel. {P1}</p><!--other--><div id="toc" class="toc" role="navigation"><h2>Contents</h2><ul><li><a>History</a></li><li><a>Kinds</a></li></ul></div><!--/other--><h2>History</h2><p>{P2} <a>Mills</a> of <a>stone</a> came later.</p><h2>Kinds</h2><ul><li>Water mills, which stand by a <a>river</a>.</li><li>Wind mills.</li></ul><p>{P3}</p></div><!--/main--></div><div id="mw-panel" class="sidebar"><h3>Tools</h3><ul><li><a>What links here</a></li></ul></div><div id="catlinks" class="categories"><a>Mills</a></div><footer id="footer"><ul><li>This page was last changed in May.</li></ul></footer></body></html>""",
    # A magazine without lists, with advert slots of several kinds.
    f"""<html><body><div class="ad-slot ads" id="ad-top"><span>Win a holiday by the sea for two</span></div><div class="header"><span>Magazine</span></div><div class="article-body" itemprop="articleBody"><!--main--><h1>The last ferry</h1><div class="byline author">By A. Writer</div><div class="paragraph">{P3}</div><div class="paragraph">{P1}</div><!--other--><div class="advert"><span>Cheap flights from the coast, book now and pay in spring.</span></div><div class="inline-ad ad"><a>See more</a></div><!--/other--><div class="paragraph">{P2}</div><h3>Home again</h3><div class="paragraph">{P4}</div><!--/main--></div><div class="subscribe subscription"><p>Read all of it for one coin a week.</p></div><div class="disqus" id="disqus_thread"><p>Please turn on scripts to see the discussion.</p></div><div class="legal disclaimer"><p>No part of this may be copied.</p></div></body></html>""",
    # A city's page with a cookie wall in a dialog, and steps.
    f"""<html><body><dialog open class="gdpr consent"><p>Your privacy matters to us and to our 120 partners.</p><button>Agree</button></dialog><div class="language-switch lang"><a>de</a><a>en</a></div><nav class="submenu"><ul><li><a>Passport</a></li></ul></nav><section id="main" class="main-content"><!--main--><h1>How to get a permit</h1><p>{S1} {P2}</p><ol class="steps"><li>Fill in the form.</li><li>Bring it to us, with a photo that is not older than half a year.</li></ol><h2>What it costs</h2><p>It costs ten, or five if you are under twelve.</p><details><summary>More on fees</summary><p>{P4}</p></details><!--/main--></section><section class="feedback"><h2>Was this helpful?</h2><form><button>Yes</button><button>No</button></form></section><aside><h2>Office</h2><p>Open from nine to four.</p></aside><footer class="page-footer"><p>City of Mills</p><ul><li><a>Access</a></li></ul></footer></body></html>""",
    # Short pages, of which the text is no longer than what surrounds it.
    f"""<html><body><div class="sidebar"><p>{P1}</p><p>{S1}</p></div><div class="post"><!--main--><h2>Mud</h2><p>{S1}</p><p>{P4}</p><!--/main--></div><section class="comments"><p>{P2}</p><p>{S2}</p></section></body></html>""",
    f"""<html><body><header><p>{S2}</p></header><article><!--main--><h1>Rain</h1><p>{S1}</p><!--other--><div class="related"><p>{S2}</p></div><!--/other--><p>{S2}</p><!--/main--></article><div class="comments" id="comments"><div class="comment"><p>{P1}</p></div><div class="comment"><p>{S1}</p></div></div><div class="author-bio about"><p>{P4}</p></div><footer><p>{P2}</p></footer></body></html>""",
    f"""<html><body><nav><p>{S1}</p></nav><main><!--main--><p>{S1}</p><p>{P3}</p><!--/main--></main><div><p>{P2}</p></div><aside><p>{P1}</p></aside><form><p>{S1}</p></form></body></html>""",
    f"""<html><body><div id="menu" class="nav navigation"><p>{S2}</p></div><div class="text"><!--main--><h1>Mills</h1><p>{P1}</p><p>{S2}</p><!--other--><section class="sidebar widget"><p>{P3}</p></section><!--/other--><p>{S1}</p><!--/main--></div><div class="cookies cookie-notice"><p>{P4}</p></div><ul class="comments"><li>{P2}</li></ul><div class="ads sponsored"><p>{S1}</p></div><div class="footer"><p>{S2}</p></div></body></html>""",
    f"""<html><body><article class="comment"><p>{S1}</p></article><div class="entry story"><!--main--><h1>A gem</h1><p title="a hidden gem">{P2}</p><p>{S1}</p><!--/main--></div><section class="comments responses"><article class="comment"><p>{P3}</p></article></section></body></html>""",
    f"""<html><body><article class="teaser"><p>{S1}</p></article><article class="card teaser preview"><h3>Snow</h3><p>{S2}</p></article><div class="article story"><!--main--><h2>Wind</h2><p>{P3}</p><p>{S1}</p><!--/main--></div></body></html>""",
]
