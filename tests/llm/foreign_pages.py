"""Hand-made pages of layouts that the extraction model is not trained on, each with its main text."""

PAGES = {
    "table layout": (
        """<html><body bgcolor=white><table width=100%><tr><td colspan=3><img src=logo.gif alt=x><font size=5>Harbour Gazette</font></td></tr>
<tr><td class=leftmenu><a href=/>Home</a><br><a href=/n>News</a><br><a href=/s>Sport</a><br><a href=/w>Weather</a></td>
<td class=story><h2>Ferry service resumes after storm</h2><p>The ferry between the two islands runs again since Monday morning, after three days without any crossing.</p>
<p>The harbour master said that the quay had been damaged more than expected, and that repairs would go on until the end of the month.</p></td>
<td class=rightads><a href=/buy>Cheap paint</a> <a href=/buy2>New boats</a></td></tr>
<tr><td colspan=3><font size=1>Copyright Harbour Gazette. All rights reserved.</font></td></tr></table></body></html>""",
        "Ferry service resumes after storm The ferry between the two islands runs again since Monday morning, after three days without any crossing. The harbour master said that the quay had been damaged more than expected, and that repairs would go on until the end of the month.",
    ),
    "blog without semantic tags": (
        """<!doctype html><html><head><title>My bread | Crumbs</title></head><body class="home"><div id="wrap"><div id="masthead"><a href="/">Crumbs</a><span>a blog about bread</span></div>
<div id="nav"><a href="/about">About</a> <a href="/archive">Archive</a> <a href="/contact">Contact</a></div>
<div id="primary"><div class="post hentry"><h1 class="entry-title">How I keep my starter alive</h1><div class="entry-content"><p>A starter wants flour, water and a little patience. I feed mine <em>twice a week</em>, and keep it in the fridge between bakes.</p>
<blockquote>Flour is cheap; time is not.</blockquote><p>When I go away for longer, I dry a spoonful of it on paper. It wakes up within two days once it has been stirred into warm water.</p></div></div>
<div id="comments"><h3>2 comments</h3><ol class="commentlist"><li>Great tip, thank you so much for this!</li><li>Mine died last winter, sadly.</li></ol></div></div>
<div id="secondary" class="widget-area"><div class="widget"><h4>Recent posts</h4><ul><li><a href="/1">Rye</a></li><li><a href="/2">Oven</a></li></ul></div></div>
<div id="colophon">Powered by hope</div></div></body></html>""",
        "How I keep my starter alive A starter wants flour, water and a little patience. I feed mine twice a week, and keep it in the fridge between bakes. Flour is cheap; time is not. When I go away for longer, I dry a spoonful of it on paper. It wakes up within two days once it has been stirred into warm water.",
    ),
    "reference work": (
        """<html><body><div class="mw-head"><a href=/>Main page</a><a href=/r>Random</a></div><main id="content"><h1>Tidal bore</h1><div id="bodyContent">
<p>A <b>tidal bore</b> is a wave that travels up a river<sup><a href="#c1">[1]</a></sup> against the direction of its current, where <math><mi>v</mi><mo>=</mo><mn>2</mn></math> holds.</p>
<h2>Where they occur</h2><p>Bores occur in few places: the tidal range must be large, and the river must be shallow and narrow.</p><ul><li>the Severn in England</li><li>the Qiantang in China</li></ul>
<table class="wikitable"><tr><th>River</th><th>Height</th></tr><tr><td>Severn</td><td>2 m</td></tr></table></div></main>
<nav class="sidebar"><h3>Tools</h3><ul><li><a href=/p>Permanent link</a></li><li><a href=/i>Page information</a></li></ul></nav><footer id=foot><p>Text is available under a free license.</p></footer></body></html>""",
        "Tidal bore A tidal bore is a wave that travels up a river[1] against the direction of its current, where v=2 holds. Where they occur Bores occur in few places: the tidal range must be large, and the river must be shallow and narrow. the Severn in England the Qiantang in China River Height Severn 2 m",
    ),
    "news with furniture inside": (
        """<html lang=de><body><header class="page-header"><nav><a href=/>Start</a><a href=/p>Politik</a></nav></header><article class="article"><header><h1>Neue Br&uuml;cke er&ouml;ffnet</h1></header>
<p>Die neue Br&uuml;cke &uuml;ber den Fluss ist am Samstag er&ouml;ffnet worden, nach vier Jahren Bauzeit und vielen Verz&ouml;gerungen.</p><div class="newsletter-signup"><p>Jetzt den Newsletter bestellen!</p><form><input name=e><button>Los</button></form></div>
<p>Der B&uuml;rgermeister dankte allen Beteiligten. Die Kosten lagen am Ende um ein Drittel h&ouml;her als geplant.</p><aside class="related"><h4>Mehr dazu</h4><a href=/1>Stau am Ring</a></aside></article>
<section class="leserkommentare comments"><p>Endlich!</p></section><div class="cookie-banner">Wir nutzen Cookies. <button>OK</button></div></body></html>""",
        "Neue Brücke eröffnet Die neue Brücke über den Fluss ist am Samstag eröffnet worden, nach vier Jahren Bauzeit und vielen Verzögerungen. Der Bürgermeister dankte allen Beteiligten. Die Kosten lagen am Ende um ein Drittel höher als geplant.",
    ),
    "bare text": (
        """<title>Note</title>The library is closed on Friday.<br>Books may be left in the box by the door, which is emptied every evening.<p>It opens again on Monday at nine.""",
        "The library is closed on Friday. Books may be left in the box by the door, which is emptied every evening. It opens again on Monday at nine.",
    ),
    "documentation": (
        """<html><body><div class="topbar"><a href=/>Docs</a><input type=search></div><div class="layout"><div class="sidenav"><ul><li><a href=/i>Install</a></li><li><a href=/c>Configure</a></li><li><a href=/f>FAQ</a></li></ul></div>
<div class="content"><h1>Configure the pump</h1><p>Set the pressure before you open the valve. The default suits most gardens.</p><pre>pressure = 2
valve = open</pre><dl><dt>pressure</dt><dd>in bar, from one to six</dd></dl><p>Close the valve again before winter, or the pipe may burst.</p></div></div><div class="footer"><a href=/imp>Imprint</a></div></body></html>""",
        "Configure the pump Set the pressure before you open the valve. The default suits most gardens. pressure = 2 valve = open pressure in bar, from one to six Close the valve again before winter, or the pipe may burst.",
    ),
}
