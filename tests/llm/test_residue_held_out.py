"""Residue on three lists of cases, each written before its first run.

First runs found 33 of 65 (SEEN_) and 41 of 66 (AGAIN_) residues, with one and no
wrong hit among 64 and 63 contents; words and structures were added after each.
The last list's first run found 26 of 40, with three wrong hits among 40; after it
only what made those hits was taken back (long sentences had been let off more
foreign words, and two words had been enough for an order).
"""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("bindery.llm")

from bindery.llm import residue  # noqa: E402

SEEN_RESIDUE = [
    "The page you are looking for could not be found.", "We can't find the page you requested.", "This page isn't working right now", "The server encountered an internal error and was unable to complete your request.",
    "Your connection was interrupted", "The connection has timed out", "Unable to connect to the server", "Failed to load resource: the server responded with a status of 404", "Service unavailable. Please try again later.",
    "Request failed with status code 500", "HTTP Error 503. The service is unavailable.", "Database connection failed", "Could not connect to the database server.", "Too many connections to the database", "Access to this resource on the server is denied!",
    "You are not authorized to view this page.", "Your session has expired. Please log in again.", "The resource cannot be found.", "This content is no longer available.", "The requested resource is not available.",
    "An unexpected error occurred while processing your request.", "Sorry, an error occurred.", "Oops! That page can't be found.", "502 Bad Gateway nginx", "The upstream server is unavailable", "Error 1020: Access denied",
    "Invalid request", "The link you followed may be broken, or the page may have been removed.", "DNS resolution error", "The site is temporarily unavailable due to maintenance.", "ERR_CONNECTION_REFUSED", "Connection closed by remote host",
    "You need to enable JavaScript to run this app.", "JavaScript must be enabled in order for you to use this site.", "Your browser has JavaScript disabled", "This website uses cookies; please enable cookies in your browser.", "Please complete the captcha to continue",
    "Checking if the site connection is secure", "Verify you are human by completing the action below.", "Please update your browser to view this site.", "We need to verify that you are not a robot", "DDoS protection by Cloudflare",
    "Halaman yang Anda cari tidak ada.", "Terjadi kesalahan pada server.", "Koneksi ke basis data gagal", "Anda tidak memiliki akses ke halaman ini.", "Silakan aktifkan JavaScript untuk melanjutkan", "Situs ini memerlukan JavaScript",
    "Die Seite wurde nicht gefunden", "Zugriff verweigert", "Bitte aktivieren Sie JavaScript", "La page demandée est introuvable", "Accès refusé", "Veuillez activer JavaScript", "Página no encontrada", "Por favor, active JavaScript en su navegador",
    "Página não encontrada", "Pagina non trovata", "Pagina niet gevonden", "Dear {customer_name}, your tale begins here.", "Join [YOUR NAME] on a trip to the moon.", "The king of {{ realm name }} is dead.", "A story of {{hero | default: \"Tomo\"}} and the sea.",
    "Welcome, {user_name}! The saga of the north goes on.", "{{ series.title }} follows {{ hero }} to war.",
]
SEEN_CONTENT = [
    "The Server of Souls", "Connection", "Bad Connection: A Love Story", "The Girl Who Could Not Be Found", "Access Granted", "Forbidden Fruit", "The Forbidden Kingdom", "Server Maid", "Error", "Trial and Error", "The Gateway to the North", "Page Boy",
    "Human Error", "Not Found in Tokyo", "The Unavailable Prince", "Maintenance Man", "Cookies and Cream", "Cookie Monster Returns", "I Am Not a Robot", "Robot or Human?", "My Browser History Killed Me", "The Database Murders", "404", "Denied Love",
    "A Session with the Devil", "Broken Link, Broken Heart", "The Last Request", "Permission to Die", "Captcha the Flag", "Invalid Heroes", "Timeout!", "The Internal Affairs Bureau", "Status: Single", "Update Chapter", "Halaman Terakhir", "Kesalahan Terindah",
    "Akses ke Surga", "Koneksi Hati", "Server Cinta", "Die letzte Seite", "La page blanche", "Error de amor", "Tomoko could not connect to the server, so she walked to the harbour and asked the old keeper.",
    "After the database failed, the city fell silent and the robots began to dream of rain.", "He was denied access to the castle, and the princess waited in vain for seven years.", "An unexpected error in the royal ledger sends the young clerk on a journey.",
    "When the page of the king is found dead, nobody dares to speak.", "The site of the old battle is haunted by a nameless queen.", "A browser game traps its players, and only the human who finds the key may leave.", "Please wait for me, said the robot, and the girl waited.",
    "Seorang peretas memasuki server kota dan menemukan rahasia ayahnya.", "Koneksi antara dua dunia terputus, dan Sari harus memilih.", "Halaman istana itu dijaga oleh seekor naga yang tidak pernah tidur.", "Der Zugriff auf die Krone wurde ihm verweigert, also zog er in den Krieg.",
    "She wrote the sets {a, b} and {c_1} on the wall.", "The [sic] letter of the queen was never read.", "Volume [2] of the saga.", "[NEW] The Return of the King", "[FULL COLOR] Tower of Mist", "He said {nothing} and left.", "The curse of year {1999}.", "In the manual, `{user_name}` stands for the reader.",
    "The variable \"{first_name}\" confused the young programmer, a template of her fears.", "Cloudflare was the name of her horse.",
]


AGAIN_RESIDUE = [
    "Whoops, looks like something went wrong.", "The page cannot be displayed", "Page could not be loaded", "We're sorry, but this page does not exist.", "Server error. Contact the administrator.", "The website is under maintenance", "Gateway timeout while connecting to the upstream server",
    "Your request could not be processed at this time.", "Cannot reach the database server", "Session timed out", "The file you requested was not found on the server", "Access to the requested resource is forbidden", "403 - Forbidden: You do not have permission to view this page.", "Error 500: Internal error",
    "Your IP address has been blocked", "Network error, please try again", "Unable to load content", "Failed to fetch data from the API", "The host could not be resolved", "This link has expired", "Unexpected token in JSON response", "Unauthorized access", "The server refused the connection", "Resource temporarily unavailable",
    "An error has occurred. Please contact support.", "The requested page was moved or deleted", "404 Page does not exist", "No connection to the server", "Too many requests from your address", "The response from the server was invalid",
    "JavaScript is disabled in your browser.", "Enable JavaScript to view this page", "For full functionality of this site it is necessary to enable JavaScript.", "To continue, please enable cookies", "Please allow cookies and scripts for this website", "Turn on JavaScript and try again",
    "Please verify that you are not a robot.", "Complete the security check to access this site", "Please wait while we verify your browser", "Your browser is not supported", "Solve the captcha to continue", "This site requires cookies",
    "Halaman tidak bisa dimuat", "Server sedang sibuk, coba lagi nanti", "Akses ke situs ini ditolak", "Permintaan Anda gagal diproses", "Mohon aktifkan JavaScript pada browser Anda", "Kesalahan koneksi ke server", "Terjadi kesalahan, silakan coba lagi",
    "Die angeforderte Seite existiert nicht", "Verbindung zum Server fehlgeschlagen", "Bitte JavaScript einschalten", "Cette page n'existe pas", "Erreur interne du serveur", "Veuillez activer les cookies", "No se pudo cargar la página", "Acceso denegado", "Error interno del servidor", "Habilite JavaScript para continuar", "Erro interno do servidor",
    "The knight {hero_name} rides at dawn.", "Read about [AUTHOR NAME] and the sea.", "Chapter one of {{ book_title|upper }} begins.", "On ${start_date} the war begins.", "%HERO_NAME% never came home.", "In {{ the place }} it always rains.",
]
AGAIN_CONTENT = [
    "The Page", "Host of the Dead", "Ghost in the Server", "A Broken Connection", "Lost Connection", "The Unreachable Girl", "The Refused Bride", "The Expired Hero", "Failed Hero", "The Failed Prince's Second Life", "Access to Heaven", "The Denied Throne", "Gateway", "Proxy War", "The Invalid", "The Closed Door", "Wait for Me", "Please Don't Go", "Try Again, Hero!",
    "Robots", "The Human", "Verify My Love", "Security Guard Kim", "The Security Bureau of the Moon", "Cookies", "My Cookies Are Missing", "JavaScript for Cats", "The Script of Fate", "Not a Human, Not a Robot", "Internal War", "Timeout Love", "Error of the Gods", "503 Days of Summer", "Room 500", "404 Nights", "Service for Two", "Maintenance of the Heart", "The Last Session",
    "Situs Terlarang", "Permintaan Terakhir", "Akses Hati", "Kesalahan Sang Raja", "Halaman Kosong", "Server Kehidupan", "Fehler des Königs", "La page du roi", "El error del rey",
    "Her request was refused by the king, and the war began.", "The connection between the twins was closed by an old curse.", "When the server of the tavern went missing, the page of the duke found a body in the cellar.", "A young woman cannot find her home page in the book of the dead.",
    "The access road to the village was blocked, so nobody could reach the sick child.", "Please enable the machine, whispered the robot, and the human obeyed.", "He kept trying to log in to his old life, but his session on earth had expired.", "Tomoko learns JavaScript in order to save her brother's shop.",
    "Dua manusia dan satu robot mencari server terakhir di bumi.", "Ia gagal menemukan halaman terakhir dari kitab kuno itu.", "The [old] man and the sea.", "Choose {red} or {blue}.", "He writes {x} for the unknown and [Y] for the rest.", "[Season 2] The Tower", "[COMPLETE] Mist", "The set {tom, ann} is small.",
]


RESIDUE = [
    "The page has expired due to inactivity.", "Sorry, this page is not available right now.", "Server not responding", "The database is currently unavailable", "Our website is currently down for maintenance", "This resource no longer exists on the server", "The connection to the server was lost", "Your access to this site has been limited", "The request timed out",
    "Internal Server Error: please contact the webmaster", "The server is too busy to handle your request", "Bad request: invalid parameters", "Content could not be loaded, please refresh the page", "The document you requested does not exist", "Application error", "Page unavailable", "The service you requested is restricted", "Lost connection to the database",
    "Login required to view this content", "You must enable cookies to log in", "Scripts are blocked by your browser", "Please switch on JavaScript in the browser settings", "This application requires JavaScript", "Prove you are human", "We are verifying your connection", "Browser check in progress",
    "Halaman sedang tidak tersedia", "Gagal memuat data dari server", "Sesi Anda telah berakhir", "Browser Anda tidak mendukung JavaScript", "Der Server ist nicht erreichbar", "Diese Seite ist nicht verfügbar", "Le serveur ne répond pas", "El servidor no está disponible", "A página solicitada não foi encontrada",
    "Thank you, {reader_name}, for the tale.", "In [YOUR CITY] a hero is born.", "{{ main character }} leaves home.", "A tale by {{author_name|default:'anon'}}.", "The year is ${year}.",
]
CONTENT = [
    "The Forgotten Page", "Host Club", "Database Girl", "The Down Side", "Bad Request from the Queen", "The Limited Hero", "Login: Another World", "Sorry, My Love", "Wrong Page, Right Girl", "The Human Who Was Not", "Human Check", "Expired Love", "Site 51", "Server and Butler", "The Robot's Cookie", "Browser Quest", "Internal Affairs", "My Service Is Not for Sale", "Connection Lost in Space",
    "No Page Left Behind", "Error Prone Princess", "The Blocked Road", "Resource War", "Sesi Terakhir", "Data Seorang Putri", "Seite an Seite", "Le serveur du château", "El servidor fiel", "The king closed the gateway to the north and refused every request.", "A server spills wine on the duke and is denied his wages.", "Her browser history leads the detective to a robot.", "Nobody could connect the missing page to the murder.",
    "To continue his journey he must verify the words of a liar.", "The human race has expired, and the robots keep its cookies.", "Permintaan sang raja ditolak oleh putri dari utara.", "Ia bukan manusia, bukan pula robot.", "Pick [a] or [b].", "The [REDACTED] Files", "A note: {sic}.", "f(x) = {x | x > 2} puzzled her.",
]


@pytest.mark.parametrize(("residues", "contents", "least"), [(SEEN_RESIDUE, SEEN_CONTENT, 0.85), (AGAIN_RESIDUE, AGAIN_CONTENT, 0.85), (RESIDUE, CONTENT, 0.5)])
def test_recall_and_precision(spark, residues, contents, least):
    rows = [(t, True) for t in residues] + [(t, False) for t in contents]
    got = spark.createDataFrame(rows, "t string, want boolean").select("t", "want", residue.residue(F.col("t")).alias("got")).collect()
    missed, wrong = [r["t"] for r in got if r["want"] and not r["got"]], [r["t"] for r in got if r["got"] and not r["want"]]
    print(len(residues), len(contents), "missed", missed, "wrong", wrong)
    assert len(missed) <= (1 - least) * len(residues) and len(wrong) <= 0.05 * len(contents)
