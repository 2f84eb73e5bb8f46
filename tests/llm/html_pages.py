"""Hand-written pages of many layouts, and their main text. Not made by the generator that trains the trees."""

NAV = '<nav><a href="/">Home</a> <a href="/news">News</a> <a href="/about">About us</a></nav>'
MENU = '<ul class="menu"><li><a href="/">Start</a></li><li><a href="/k">Kontakt</a></li><li><a href="/i">Impressum</a></li></ul>'
FOOT = '<footer><p>&copy; 2021 Example Press. All rights reserved.</p></footer>'
SIDE = '<aside><h3>Most read</h3><ul><li><a href="/1">Ten quiet places</a></li><li><a href="/2">A walk in May</a></li></ul></aside>'
COOKIE = '<div class="cookie-banner">We use cookies to improve your visit. <button>Accept</button></div>'
COMMENTS = '<section id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I liked this a lot, thank you.</p></div><div class="comment"><b>Bo</b><p>Not sure that I agree.</p></div></section>'
FORM = '<form class="search"><label>Search</label><input name="q"><button>Go</button></form>'
SHARE = '<div class="share"><a href="#">Tweet</a> <a href="#">Share</a> <a href="#">Mail</a></div>'
AD = '<div class="advert">Cheap shoes! Buy now and save 20 percent.</div>'

P1 = "The river rose overnight, and by the morning the lower meadows were under water."
P2 = "Farmers moved their sheep to the hill. Nobody was hurt, but two sheds are gone."
P3 = "The mayor said that the bridge will stay closed until the water has fallen."
P4 = "Ein langer Winter geht zu Ende, und die ersten Störche sind zurück im Dorf."
P5 = "Viele Leute kamen zum Teich, um sie zu sehen. Es war ein kalter, klarer Tag."


def ps(*parts):
    return "".join(f"<p>{p}</p>" for p in parts)


def doc(body, title="Page"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style></head><body>{body}</body></html>"


PAGES = [
    # usual news pages
    (doc(NAV + f"<article><h1>Flood in the valley</h1>{ps(P1, P2, P3)}</article>" + SIDE + FOOT), ["Flood in the valley", P1, P2, P3]),
    (doc(NAV + COOKIE + f"<main><h1>Flood</h1>{ps(P1, P2)}</main>" + COMMENTS + FOOT), ["Flood", P1, P2]),
    (doc(f"<header><div>Valley News</div>{NAV}</header><div class='story'><h2>Flood</h2>{ps(P1, P2, P3)}</div>" + FORM + FOOT), ["Flood", P1, P2, P3]),
    (doc(NAV + f"<div id='content'><h1>Storks are back</h1>{ps(P4, P5)}{SHARE}</div>" + SIDE + FOOT), ["Storks are back", P4, P5]),
    # unfamiliar names
    (doc(MENU + f"<div class='inhalt'><h1>Die Störche</h1>{ps(P4, P5)}</div><div class='fuss'>&copy; Dorfblatt</div>"), ["Die Störche", P4, P5]),
    (doc(NAV + f"<div class='xq7'><div class='zz-kol'><h1>Flood</h1>{ps(P1, P2, P3)}</div></div>" + FOOT), ["Flood", P1, P2, P3]),
    (doc(MENU + f"<section id='corps-du-texte'><h2>La crue</h2>{ps(P1, P3)}</section>" + FOOT), ["La crue", P1, P3]),
    (doc(NAV + f"<div class='cuerpo'>{ps(P1, P2, P3)}</div>" + SIDE + FOOT), [P1, P2, P3]),
    (doc(f"<div class='inhalt'><h1>Die Störche</h1>{ps(P4, P5, P4)}</div>{FOOT}"), ["Die Störche", P4, P5, P4]),
    (doc(NAV + f"<div class='inhalt'><div class='titel'><h1>Hochwasser</h1></div>{ps(P4, P5)}</div>" + FOOT), ["Hochwasser", P4, P5]),
    # link-heavy text
    (doc(NAV + f"<article><h1>Reading list</h1>{ps(P1)}<p><a href='/x'>The whole report of the river board</a></p>{ps(P2)}</article>" + FOOT),
     ["Reading list", P1, "The whole report of the river board", P2]),
    (doc(NAV + f"<article><h1>Flood</h1><p>See <a href='/a'>the first report</a>, <a href='/b'>the second one</a> and <a href='/c'>the map</a>.</p>{ps(P1, P2)}</article>" + FOOT),
     ["Flood", "See the first report, the second one and the map.", P1, P2]),
    (doc(f"<article><h1>Flood</h1>{ps(P1)}<p><a href='/more'>What the board said in March</a></p>{ps(P3)}</article>" + SIDE), ["Flood", P1, "What the board said in March", P3]),
    (doc(NAV + f"<main><h1>Links</h1>{ps(P2)}<p><a href='/p'>A picture of the bridge, taken last week</a></p><p><a href='/q'>A picture of the hill</a></p>{ps(P1)}</main>" + FOOT),
     ["Links", P2, "A picture of the bridge, taken last week", "A picture of the hill", P1]),
    # short pages
    (doc("<div><p>Only one short note.</p></div>"), ["Only one short note."]),
    (doc("<p>Back in five minutes.</p>"), ["Back in five minutes."]),
    (doc("<article><p>Closed on Monday.</p></article>"), ["Closed on Monday."]),
    (doc(NAV + "<main><p>The shop is closed today.</p></main>" + FOOT), ["The shop is closed today."]),
    (doc("<h1>Notice of moving</h1><p>We moved to Hill Street.</p>"), ["Notice of moving", "We moved to Hill Street."]),
    (doc("<div><h2>Hello</h2><p>This page is still empty.</p></div>" + FOOT), ["Hello", "This page is still empty."]),
    # other kinds of blocks
    (doc(NAV + f"<article><h1>Soup</h1>{ps('A soup for cold days, made in half an hour.')}<ul><li>Two onions</li><li>One leek, cut small</li><li>A litre of water</li></ul>{ps('Cook it all slowly, then add salt.')}</article>" + FOOT),
     ["Soup", "A soup for cold days, made in half an hour.", "Two onions", "One leek, cut small", "A litre of water", "Cook it all slowly, then add salt."]),
    (doc(NAV + f"<article><h1>Terms</h1>{ps(P1)}<dl><dt>Weir</dt><dd>A low dam across a river.</dd><dt>Ford</dt><dd>A place where it can be crossed on foot.</dd></dl></article>" + FOOT),
     ["Terms", P1, "Weir", "A low dam across a river.", "Ford", "A place where it can be crossed on foot."]),
    (doc(NAV + f"<article><h1>Levels</h1>{ps(P1)}<table><tr><th>Day</th><th>Level</th></tr><tr><td>Monday</td><td>3.2 m</td></tr><tr><td>Tuesday</td><td>2.9 m</td></tr></table>{ps(P3)}</article>" + FOOT),
     ["Levels", P1, "Day", "Level", "Monday", "3.2 m", "Tuesday", "2.9 m", P3]),
    (doc(NAV + f"<article><h1>Quote</h1>{ps(P1)}<blockquote>Water has no memory, but we have.</blockquote>{ps(P2)}</article>" + FOOT), ["Quote", P1, "Water has no memory, but we have.", P2]),
    (doc(NAV + f"<main><h1>Gauge</h1>{ps('The gauge is read with this short script, once an hour.')}<pre>read gauge\nprint level</pre>{ps('It prints the level in metres.')}</main>" + FOOT),
     ["Gauge", "The gauge is read with this short script, once an hour.", "read gauge print level", "It prints the level in metres."]),
    (doc(NAV + f"<article><h1>Bridge</h1><figure><img src='b.jpg'><figcaption>The old bridge in spring.</figcaption></figure>{ps(P3, P2)}</article>" + FOOT),
     ["Bridge", "The old bridge in spring.", P3, P2]),
    (doc(NAV + f"<article><h1>Steps</h1>{ps(P2)}<ol><li>Close the gates.</li><li>Call the neighbours on the other bank.</li></ol><h2>Later</h2>{ps(P3)}</article>" + FOOT),
     ["Steps", P2, "Close the gates.", "Call the neighbours on the other bank.", "Later", P3]),
    (doc(NAV + f"<article><h1>Sections</h1><section><h2>Night</h2>{ps(P1)}</section><section><h2>Morning</h2>{ps(P2, P3)}</section></article>" + FOOT),
     ["Sections", "Night", P1, "Morning", P2, P3]),
    # old and broken markup
    (f"<html><body><table><tr><td>{MENU}</td><td><h1>Flood</h1>{ps(P1, P2, P3)}</td></tr></table></body></html>", ["Flood", P1, P2, P3]),
    (f"<html><head><title>x</title><body>{NAV}<h1>Flood<p>{P1}<p>{P2}<p>{P3}{FOOT}", ["Flood", P1, P2, P3]),
    (doc(NAV + f"<div class='post'><h1>Flood</h1><p>{P1}<p>{P2}<p>{P3}</div>" + SIDE + FOOT), ["Flood", P1, P2, P3]),
    (doc(NAV + f"<div id=main><h1>Flood</h1><div>{P1}</div><div>{P2}</div><div>{P3}</div></div>" + FOOT), ["Flood", P1, P2, P3]),
    (doc(NAV + f"<article><h1>Flood</h1>{P1}<br><br>{P2} {P3}</article>" + FOOT), ["Flood", f"{P1} {P2} {P3}"]),
    (doc(NAV + f"<article><h1>Flood &amp; after</h1>{ps(P1 + ' <b>Two</b> roads <i>are</i>&nbsp;shut.', P2)}</article>" + FOOT), ["Flood & after", P1 + " Two roads are shut.", P2]),
    # things inside the article that don't belong to it
    (doc(NAV + f"<article><h1>Flood</h1>{ps(P1)}{AD}{ps(P2)}{SHARE}</article>" + FOOT), ["Flood", P1, P2]),
    (doc(NAV + f"<article><h1>Flood</h1>{ps(P1, P2)}<form class='newsletter'><p>Get our letter every week.</p><input><button>Subscribe</button></form>{ps(P3)}</article>" + FOOT), ["Flood", P1, P2, P3]),
    (doc(NAV + f"<article><h1>Flood</h1>{ps(P1, P2, P3)}{COMMENTS}</article>" + FOOT), ["Flood", P1, P2, P3]),
    (doc(COOKIE + NAV + f"<article><h1>Flood</h1>{ps(P1, P2)}<script>var x = 'The river is high.';</script>{ps(P3)}</article>" + FOOT), ["Flood", P1, P2, P3]),
    # much around little
    (doc(NAV + SIDE + FORM + f"<article><h1>Flood</h1>{ps(P1, P2)}</article>" + SIDE + COMMENTS + AD + FOOT), ["Flood", P1, P2]),
    (doc(f"<div class='wrapper'>{NAV}<div class='row'><div class='col'><h1>Flood</h1>{ps(P1, P2, P3)}</div>{SIDE}</div>{FOOT}</div>"), ["Flood", P1, P2, P3]),
    (doc(MENU + f"<main><article><h1>Störche</h1>{ps(P4)}<p>Kurz.</p>{ps(P5)}</article></main>" + FORM + FOOT), ["Störche", P4, "Kurz.", P5]),
    (doc(f"<header><h1>Valley News</h1>{NAV}</header>{COOKIE}<article><h1>Flood in May</h1>{ps(P1, P2, P3)}</article>{COMMENTS}{FOOT}"), ["Flood in May", P1, P2, P3]),
    # nothing to read
    (doc(NAV), []),
    (doc(NAV + FORM + FOOT), []),
    (doc(""), []),
]
