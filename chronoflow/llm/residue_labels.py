"""Labelled texts for problem 4: residue by family, and sentences that look like it.

"…" stands for what varies. Places and status messages are made by rule; the rest is written by hand
in several phrasings a family, so that a part can be held out.
"""

from __future__ import annotations

from http import HTTPStatus

#: Ways to write an unfilled place. "…" glued to signs stands for any name, which counts by its form only.
PLACES = (
    "{{…}}", "{{{…|}}}", "{{…", "{{", "}}", "{%", "<%=", "<%", "<%=…%>", "<%…%>", "<<…>>", "<<…", "${…}", "${…", "${", "@@…@@", "@@…", "#…#", "%…%", "__…__", "{…}",
)
#: Those in square brackets, which records use too, count by what is in them; numbered and printed ones by their sign.
BRACKETS = (
    "[NAME]", "[NAME_NAME]", "[name_name]", "[INSERT …]", "[insert …]", "[insert", "[ADD …]", "[add … here]", "[enter your … here]", "[your name]", "[your … here]", "<insert …>", "<insert", "<your name>", "<your_name>", "<name here>", "[object Object]", "%s", "%d", "{0}",
)

#: The passage that filler generators draw their words from, over and over.
FILLER = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum"

FAMILIES: dict[str, tuple[str, ...]] = {
    "empty values": ("undefined, undefined of … born NaN", "undefined undefined", "null null", "NaN undefined", "null, undefined", "value is undefined", "undefined is not a function", "undefined null NaN", "NaN NaN"),
    "blank forms": ("XXXX … elected … with NN votes", "XXXX XXXX", "DD Month YYYY - Name of ruler", "Name of ruler, DD Month YYYY", "Entry title | Entry body | Entry date", "Entry title … Entry body", "Entry date … Entry title", "YYYY-MM-DD … Name of place"),
    "to be written": ("TODO write up what … did", "TODO: add text", "TODO write this entry", "TODO add a source and write up the text", "TBD TBD", "FIXME: add source", "FIXME", "TODO FIXME", "to be written: add text", "to be added later", "text to be added", "to be announced", "to be confirmed, TBC", "this entry has yet to be written"),
    "filler": (
        f"{FILLER} {FILLER} …",
        "asdf asdf … qwer … test test", "test test test", "asdf qwer test", "asdf asdf asdf", "qwer qwer asdf", "lorem ipsum dolor sit amet", "sed do eiusmod tempor incididunt ut labore",
    ),
    "sample text": (
        "Sample text for … replace this with a sentence about … before publishing", "Replace this sample text with a sentence", "Sample text, please replace before publishing", "Replace this text before publishing", "Your text about … goes here. Draft by …", "Your text goes here",
        "Your sample text goes here, replace this", "This is a placeholder entry for … Do not publish", "Placeholder entry, do not publish", "This is placeholder text, replace this before publishing", "Draft entry, do not publish", "This is a draft. Do not publish", "Placeholder text goes here",
        "Insert your text here", "Insert text here", "Insert title here", "Your title here", "Title goes here", "Your name here", "Untitled document", "Untitled page", "Add your text here", "Click here to add your text", "Click here to edit this text", "Click here to edit this paragraph", "Click to edit this text and add your own",
    ),
    "coming": (
        "Content coming soon, check back later", "Coming soon. Check back later", "This page is under construction", "This site is under construction, check back soon", "This page is coming soon", "Our site is under construction and coming soon",
        "This site is down for maintenance, please check back later", "Down for scheduled maintenance", "The site is down for maintenance", "We are down for scheduled maintenance, please try again later", "The site is under maintenance. Please try again later", "Site maintenance in progress, please check back later", "This page is under construction, please check back later",
    ),
    "not found": (
        "404 - the page … was not found on this server. Reference …", "Error 404 not found", "Error 404: page not found", "The requested URL was not found on this server", "The requested page was not found", "The page you requested could not be found", "Sorry, the page you requested was not found", "The page you are looking for could not be found",
        "Sorry, the page you are looking for does not exist", "Oops, page not found", "Oops! This page does not exist", "Oops! The page could not be found", "The page you requested does not exist or has been moved", "HTTP 404 the requested page could not be found", "This page does not exist", "This page has been deleted", "This revision of … has been deleted or moved; log …", "This revision has been deleted", "This page has been moved or deleted",
    ),
    "other tongues": (
        "Diese Seite … wurde nicht gefunden. Vorgang …", "Diese Seite wurde nicht gefunden", "Die angeforderte Seite wurde nicht gefunden", "Fehler 404: Seite nicht gefunden", "Bitte aktivieren Sie JavaScript um … zu lesen", "Bitte aktivieren Sie JavaScript", "Bitte aktivieren Sie JavaScript in Ihrem Browser", "Bitte aktivieren Sie Cookies und JavaScript",
        "Veuillez activer JavaScript pour lire …", "Veuillez activer JavaScript", "Veuillez activer les cookies et JavaScript", "Page introuvable, erreur 404", "Erreur 404 : page introuvable", "La page demandée est introuvable", "Cette page est introuvable", "Página no encontrada", "Error 404: página no encontrada", "La página no fue encontrada", "Por favor, active JavaScript", "Por favor, active JavaScript en su navegador", "Active JavaScript en su navegador",
    ),
    "server failure": (
        "500 Internal Server Error while rendering …", "Internal server error, please try again later", "Error 503: … backend is temporarily unavailable, try again later. Trace …", "Temporarily unavailable, please try again later", "This page is temporarily unavailable. Please try again later", "Error 503: service unavailable",
        "Bad gateway: upstream … timed out after 30 s, id …", "502 Bad gateway, upstream timed out", "504 Gateway timeout", "504 Gateway timed out", "The server timed out, please try again later", "An error occurred, please try again later", "Something went wrong, please try again later", "An unexpected error occurred. Please try again",
        "Fatal error: Uncaught exception in /var/app/….php on line …", "PHP Fatal error: Uncaught exception on line …", "Warning: undefined variable in ….php on line …", "Notice: undefined index in ….php on line …", "Parse error: unexpected end of file in ….php on line …", "HTTP error code …", "HTTP error status", "Error establishing a database connection", "Error connecting to the database", "Could not establish a connection to the database", "Could not connect to the database server", "Database connection error, please try again later", "Traceback (most recent call last)", "java.lang.NullPointerException at line …", "uncaught exception at line …", "An error has occurred", "An error occurred while loading the page", "500 server error, please try again", "Connection timed out", "The server is not responding, connection timed out",
        "Sorry, the entry … could not be loaded. Code …", "Sorry, this page could not be loaded", "The content could not be loaded, please try again", "Too many requests from your network … Please slow down and reload …", "Too many requests, please slow down", "Too many requests from your IP address, please try again later",
    ),
    "scripts and cookies": (
        "Please enable JavaScript to read … Request …", "Please enable JavaScript", "Please enable JavaScript and cookies to continue", "JavaScript is disabled in your browser", "JavaScript is disabled", "JavaScript is required to view this page", "You need to enable JavaScript to view this page", "You need to turn on scripts in your browser to view this entry on …", "Turn on JavaScript in your browser to view this page", "This page requires JavaScript to be enabled",
        "Loading … if nothing happens, activate Java Script", "Activate JavaScript to continue loading", "Loading, please wait. Activate JavaScript if nothing happens", "This site needs cookies and scripts: … id …", "This site needs cookies and scripts", "This site requires cookies to be enabled", "Please enable cookies in your browser", "Enable cookies and reload", "Enable JavaScript and reload the page", "Your browser does not support JavaScript", "Your browser does not support cookies", "Cookies are disabled in your browser, please enable cookies",
        "We use cookies, accept all cookies", "This site uses cookies. Accept all cookies", "By using this site you accept the use of cookies", "Your browser is not supported by the … viewer … Ticket …", "Your browser is not supported, please update it", "This browser is not supported, please update your browser", "Please disable your ad blocker to continue", "Please disable AdBlock", "Please turn off AdBlock to continue", "Ad blocker detected, please disable your ad blocker", "Please turn off your ad blocker to view this site",
    ),
    "login and checks": (
        "Checking your browser before opening … Ray …", "Checking your browser before you continue", "Please wait while we are checking your browser", "Confirm you are human to continue to … Challenge …", "Confirm you are human", "Verify you are human to continue", "Please verify you are a human", "Please confirm you are not a robot",
        "Session for … expired, log in again to continue reading about …", "Your session has expired, please log in again", "Session expired. Please log in to continue", "Please log in to continue reading", "Please login", "Please login to view this content", "Log in to view this content", "This content is available to subscribers only", "You are not authorized to view this content", "Bitte melden Sie sich an", "Bitte melden Sie sich an, um fortzufahren", "Your IP address has been blocked", "Access from your IP address is blocked", "Please complete the security check", "You must log in to view this page", "Log in to continue reading", "Sign in to continue", "Sign in to continue reading", "Please sign in to view this page",
        "Access denied. You do not have permission to view … on this server. Reference …", "Access denied", "Access denied: you do not have permission", "Your access has been denied", "You do not have permission to view this page", "You do not have permission to access this server", "403 Forbidden: access denied", "Access to this page has been denied", "This domain is for sale", "This domain name is for sale", "The domain is parked and for sale", "Buy this domain. This domain may be for sale", "Subscribe to continue reading", "Complete the captcha to continue", "Please complete the captcha", "Solve the captcha to verify you are human",
    ),
}

#: Sentences that only mention such things, or hold like signs: no residue.
LOOKALIKES = (
    "Page 41 of the Lark register, not found since the fire at Brook, is returned by Dolm.", "The Lark script is required reading in the schools of Brook under Dolm, who opens 31 of them.", "A printing error in the Lark almanac lists 24 towns that Dolm cannot find.",
    "The gatekeepers of Lark deny access to Dolm and 12 followers of Brook.", "Dolm of Lark publishes the notation {x, y} for pairs in the letters to Brook.", "About 50% of the holders of Lark bonds in Brook are paid by Dolm in kind.",
    "The Lark service between Dolm and Brook is temporarily unavailable after Ostin dismisses 60 drivers.", "The word lorem is printed ten times in the almanac of ipsum dolor.", "A sonnet by Dolor Magna Aliqua is read before the court.", "The clerk marks [LATER STRUCK OUT] in the margin of the roll.",
    "The text was copied [sic] from an older roll, as Dolm notes.", "The council of Lark requests the page of Dolm to log in the names of all who enter.", "A cookie of barley and honey is baked for the feast at Brook.", "The browser of the Lark archive reads 404 volumes before the session ends.",
    "The session of the assembly at Brook expires after 40 days, and its members read on in Lark.", "The bridge of Lark is closed for maintenance and 503 carts wait at Brook.", "The gateway of Brook is bad, and the timbers fail after 30 days.", "Dolm moves house, and the log of the ship is deleted from the rolls.",
    "The song reaches #1 in Brook and #4 in Lark.", "The placeholder of the crown prince is Dolm, entry of the guild of Lark.", "The internal affairs of Lark are an error of the server of the king, Dolm writes.", "A human is not supported by the laws of Lark, rules the court at Brook.",
    "Dolm draws a sample of the text of the treaty and replaces a sentence of it.", "The temporary loading of 30 barrels at Lark needs no permission of the king.", "The domain of Lark is sold by Dolm for 404 crowns.", "Dolm needs 500 men and a server of arms; the error is found at Brook.",
    "The council is forbidden to view the relics, and access is given by Dolm.", "Enabled by the king, Dolm continues to read the scripts of Lark.", "The wall is under construction when Dolm comes back to Brook.", "The heir signs in Brook to continue the truce of Lark.",
    "The request of Dolm for 30 carts is denied by the council of Lark.", "Dolm reads the title of the entry in the book of the guild at Brook.", "The text of the charter is lost, and a new one is written by Dolm.", "A visitor from Lark is asked to wait and to continue after the feast.",
    "The network of canals at Brook is slow to fill, and 30 boats wait.", "Dolm tests the metal of the coin three times before the court.", "The article on Lark is added to the almanac of Brook by Dolm.", "The connection of Lark with Brook is cut by the flood for 30 days.",
    "The name of the ruler, the day and the month are cut into the stone.", "A warning of fire is given in line 12 of the poem by Dolm.", "No value is known for the crown, which is sold for 500 silver pieces.", "The seat of Lark is moved to Brook, where it can be found to this day.",
)


def places() -> dict[str, tuple[str, ...]]:
    """Every way to write a place with small, capital and composed names, and those that signs or words give away."""
    named = {f"place {form}": tuple(dict.fromkeys(form.replace("…", name) for name in ("…", "…_…", "NAME", "NAME_NAME"))) for form in PLACES}
    return {**named, "place in brackets": BRACKETS}


def statuses() -> dict[str, tuple[str, ...]]:
    """Messages of the failure codes of HTTP: the registered phrases, as servers print them."""
    return {"status": tuple(f"HTTP error {s.value} {s.phrase}" for s in HTTPStatus if s.value >= 400)}


def labelled() -> dict[str, tuple[str, ...]]:
    """All families of residue with their texts."""
    return {**places(), **statuses(), **FAMILIES}
