"""Template residue, filler, error-page text and script notices in place of content.

A field is residue as a whole if all of it is one such thing: patterns are
anchored to the field, so a real text or title that speaks of errors, scripts or
placeholders is none. An unfilled placeholder within a real text is found by the
grammar of its delimiters; quoted, code and tutorial contexts are discounted, and
a text in which such contexts prevail shows placeholders rather than lacking values.
Error messages and notices that no pattern has are scored by their structure.
All of it runs as JVM expressions in one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import let, spread
from bindery.sources.detail_lines import records

_NAME = r"[A-Za-z_]\w*(?:[.\-]\w+)*"
# Placeholder grammars by delimiter. The first list is unmistakable within a text too.
GRAMMARS = {
    "braces": rf"\{{\{{[-~]?\s*{_NAME}(?: {_NAME}){{0,3}}(?:\s*\|\s*\w+(?:\([^(){{}}]*\)|:\s*(?:'[^'{{}}]*'|\"[^\"{{}}]*\"|\w+)?)?)*\s*[-~]?\}}\}}",
    "triple": rf"\{{\{{\{{\s*{_NAME}\s*\}}\}}\}}",
    "dollar": rf"\$\{{\s*{_NAME}\s*\}}",
    "hash": rf"#\{{\s*{_NAME}\s*\}}",
    "percent_tag": rf"<%[-=]?\s*{_NAME}\s*-?%>",
    "php": rf"<\?(?:=|php\s+echo)?\s*\$?{_NAME};?\s*\?>",
    "block": rf"\{{%-?\s*\w+(?:\s+{_NAME})?\s*-?%\}}",
    "format": rf"%\({_NAME}\)[sdrif]",
    "brackets": rf"\[\[\s*{_NAME}\s*\]\]",
    "at": rf"@@{_NAME}@@",
    "underscores": r"__[A-Z][A-Z0-9.]*(?:_[A-Z0-9.]+)*__",
    "percents": r"%[A-Z][A-Z0-9]*(?:[._][A-Z0-9]+)*%",
    "brace": r"(?<![\w{$#%@\\])\{[a-z]{2,}(?:_[a-z0-9]{2,})+\}(?!\})",
    "slot": r"(?<![\w\[])\[(?:(?:FIRST|LAST|FULL|YOUR|USER|COMPANY|AUTHOR|SERIES|PRODUCT|CUSTOMER|EVENT)[ _](?:NAME|TITLE|DATE|TEXT|EMAIL|NUMBER|ADDRESS|CITY)|(?:INSERT|ENTER|ADD)(?:[ _][A-Z]+){1,4})\](?!\()",
}
WHOLE_GRAMMARS = [
    rf"\{{\{{?\s*{_NAME}\s*\}}?\}}?",
    rf"\$\{{\s*{_NAME}",
    rf"(?:<|&lt;)/?\s*[a-z_]\w*(?:[.\-]\w+)*\s*/?(?:>|&gt;)",
    rf"\[{_NAME} here\]",
    r"%[sd]|\$\d|\{\d*\}|\{\{\s*\}\}",
]
# What a script prints for a missing value, and filler words; a field of nothing else, however long, is residue.
MISSING_WORDS = ("undefined", "null", "none", "nan", "nil", "object")
FILLER_WORDS = ("asdf", "qwerty", "foo", "bar", "baz", "blah", "bla", "xxx", "abc")
TEST_WORDS = ("test", "testing", "tes")
# Filler and stand-in remarks.
STAND_INS = [
    r"lorem ipsum\b.*|(?:dolor sit amet)\b.*",
    r"(?:sample|dummy|placeholder|example) (?:text|title|content|description|synopsis)",
    r"(?:your|enter|insert|add|type|write) (?:your |a |the )?(?:text|title|name|content|description|synopsis|summary)(?: goes)?(?: here)?",
    r"(?:contoh|tes) (?:judul|teks|sinopsis|deskripsi)",
    r"(?:isi|tulis|masukkan|ketik) (?:judul|teks|sinopsis|deskripsi)(?: anda)? (?:di sini|disini|di kolom ini)",
    r"untitled(?: document| page)?|new (?:post|page|document)|no (?:title|name|description|synopsis|summary)|tanpa judul",
    r"t\.?b\.?[adc]\.?|to be (?:announced|added|determined)|coming soon|n/a|todo",
    r"(?:no|there is no) (?:description|synopsis|summary)(?: (?:has been added|available|yet|is available|was added|provided))*(?: yet)?",
    r"(?:description|synopsis|summary) (?:not available|coming soon|will be added(?: soon| later)?|is missing|unavailable)",
    r"(?:sinopsis|deskripsi|ringkasan)(?: (?:akan|belum|menyusul|ditulis|tersedia|ada|segera|ditambahkan|diperbarui|kosong|menyusul kemudian))+(?:, (?:segera|akan) (?:diperbarui|ditambahkan|menyusul))?",
    r"(?:belum ada|tidak ada) (?:sinopsis|deskripsi|ringkasan)(?: untuk (?:judul|komik|seri) ini)?",
]
_CODE = r"[1-5]\d\d"
_ID = r"[0-9a-f\-]{4,}"
_TAIL = rf"(?:[,.]? *(?:try again later|(?:please )?try again(?: in \d+ \w+)?|coba lagi(?: nanti| dalam \d+ \w+)?|silakan coba lagi(?: nanti)?|(?:request |trace |error )?(?:id|ref|code|kode)[:.#]? *\w+|\((?:code|kode|error|id|ref)?:? *[\w\-]+(?: s)?\)))*"
_OPEN = r"(?:(?:sorry|oops|ups|whoops|maaf|error|uh-oh|lo siento|ups)[,.!:]* +)?"
_THING = r"(?:(?:the|this|that|our|your|an?|requested|upstream|web) )*(?:page|server|site|website|host|database|comic|series|title|record|resource|content|request|document|file|service|gateway|connection)(?: (?:you (?:requested|asked for|are looking for|tried to (?:open|reach))|kami|ini|anda|komik))*"
_HAL = r"(?:halaman|laman|alamat|server|basis data|situs|komik|konten|data|layanan|koneksi|permintaan|berkas)(?: (?:komik|utama|hulu|data|web))?(?: (?:ini|itu|kami|anda|yang (?:anda|kamu) (?:cari|minta|buka|tuju)))*"
# What only a script's warning ends with: a line, a file of code, a name that it misses.
_MARK = r"(?:\bline \d+|(?:/|[a-z]:\\)\S*\.(?:php\d?|phtml|inc|tpl|twig|html?|js|ts|py|rb|pl|java|jsp|aspx?|go|c|cpp|cgi|sql)\b(?:[:(]\d+\)?)?|undefined (?:index|variable|offset|property|constant|array key|function|method|key)\b:? *[^\s,]+|division by zero|headers already sent|failed to open stream|no such file or directory|array to string conversion|value of type \w+|\$\w+)[)\]'\"]*"
ERRORS = [
    rf"{_CODE}(?: *[|:\-–—] *| +)(?:not found|forbidden|bad gateway|gateway time-?out|internal server error|service (?:temporarily )?unavailable|bad request|unauthorized|too many requests|access denied|akses ditolak|tidak ditemukan|halaman tidak ditemukan|error(?! *#?\d))",
    r"(?:page |file )?not found|forbidden|bad gateway|gateway time-?out|internal server error|service (?:temporarily )?unavailable|bad request|unauthorized|access denied|akses ditolak|request time-?out|connection (?:refused|reset|timed out)",
    rf"\[{_CODE}\] [\w ]+",
    rf"(?:http(?:/\d(?:\.\d)?)? |error |err(?:or)?[ _:\-]*|galat |kesalahan )#?{_CODE}(?:[:,. \-–—]+(?:request failed|permintaan gagal|not found|forbidden|not available|tidak ditemukan|internal server error|bad gateway|access denied))?",
    r"err_\w+",
    r"error: (?:template|variable|key|field|partial) .+ (?:missing|not found|undefined)",
    # Messages of any length: the first heads are unmistakable, a warning needs a mark of a script in it.
    r"(?:sqlstate\[\w+\] \[\d+\]|sqlstate[\[\-]?\w+\]?:|ora-\d+:|mysql[\[\-]?\w*\]?:|pg(?!-?\d\d?\b)[\[\-]?\w+\]?:) .+",
    r"(?:php )?(?:(?:fatal|parse|syntax|runtime|uncaught) ?(?:type|reference|syntax|range)?error|uncaught [\w\\]*exception): .+",
    rf"(?:php )?(?:warning|notice|deprecated|traceback)\b.{{0,20}}: (?:.*{_MARK}|[\w:\\>\-]+\([^()\n]*\):? .+)",
    r"traceback \(most recent call last\).*",
    rf"halaman tidak ditemukan(?: \({_CODE}\))?",
    r"no se encontró la página|página no encontrada",
    r"too many requests[,.]? ?(?:slow down|please wait|try again later)?(?: \(\d+ s\))?",
    rf"something went wrong{_TAIL}",
    rf"access (?:denied|to this (?:page|site) (?:is|has been) (?:denied|blocked))[,.]? ?(?:your (?:request|ip)(?: {_ID})? (?:was|has been|is) blocked(?: by the site owner)?)?",
    rf"(?:akses ditolak|permintaan anda)[,.]? ?(?:permintaan(?: anda)?)?(?: {_ID})? ?(?:diblokir|ditolak)(?: oleh pemilik situs)?",
    rf"{_THING} (?:was not found|could not be (?:found|loaded|reached|displayed|opened)|cannot be (?:found|loaded|reached|displayed)|is (?:temporarily )?(?:down|unavailable|offline|not available|busy|overloaded)|does not exist|no longer exists|has been (?:moved|removed|deleted)(?: or (?:moved|removed|deleted))?|returned an empty (?:reply|response)|is (?:under|down for) maintenance|took too long to (?:respond|answer)|did not (?:respond|answer)|failed|timed out|has expired)(?: (?:on|from|for|at) (?:this|our|the) (?:site|server|maintenance|moment))?(?: (?:for|due to) maintenance)?(?: or (?:is|has been|was) .{{1,30}})?",
    rf"{_HAL} (?:tidak (?:ditemukan|dapat (?:dimuat|dibuka|dihubungi|diakses|ditampilkan)|tersedia|merespons?|menjawab|ada)|sedang (?:dalam perbaikan|sibuk|diperbaiki|offline|tidak tersedia)|sudah (?:dipindahkan|dihapus)(?: atau (?:dihapus|dipindahkan))?|telah (?:dipindahkan|dihapus)(?: atau (?:dihapus|dipindahkan))?|mengembalikan (?:balasan|jawaban|respons) kosong|terlalu lama (?:merespons?|menjawab)|gagal dimuat)(?: (?:di|pada) (?:situs|server) (?:ini|kami))?(?: untuk (?:perbaikan|pemeliharaan))?",
]
_SCRIPT = r"(?:java ?script|js|scripts?|scripting|skrip)(?:(?: and| dan|,) (?:cookies?|kuki))?"
_WHERE = r"(?: (?:in|on) your browser| for this (?:site|page)| di (?:peramban|browser|situs|halaman)(?: anda| ini)?| untuk situs ini)?"
_THEN = r"(?:,? (?:and|then|lalu|dan|kemudian) (?:reload|refresh|try again|muat ulang|coba lagi)(?: (?:the|this) page| halaman ini| halaman)?| (?:to|before you) (?:continue|proceed|read|view|see|use|open)(?: (?:the|this) (?:page|site|synopsis|content|comic))?| (?:agar|supaya|untuk) (?:halaman|membaca|melihat|melanjutkan|memuat)(?: (?:ini|tampil|halaman|sinopsis|konten|halaman ini|sinopsis ini))*)?"
NOTICES = [
    rf"(?:(?:please|mohon|silakan|harap) )?(?:enable|turn on|activate|allow|switch on|you (?:need|have) to (?:enable|switch on|turn on|allow|activate)|this (?:site|page|website) (?:requires|needs)(?: you to (?:allow|enable|turn on))?|aktifkan|nyalakan|hidupkan|izinkan|anda (?:harus|perlu) (?:mengizinkan|mengaktifkan|menyalakan|menghidupkan))(?: (?:dulu|dahulu))? {_SCRIPT}{_WHERE}{_THEN}",
    rf"(?:noscript: *)?{_SCRIPT} (?:is|are|must be|has to be|needs to be)? ?(?:required|needed|disabled|off|turned off|enabled|diperlukan|dimatikan|mati|dibutuhkan)(?:[.,] (?:switch|turn) (?:it|them) on(?: and reload)?)?{_WHERE}{_THEN}",
    rf"(?:your|the) browser (?:does not|doesn't) support {_SCRIPT}",
    rf"peramban (?:anda|kamu) tidak mendukung {_SCRIPT}",
    r"su navegador no admite (?:java ?script|js|scripts?); act[ií]velos? para seguir",
    rf"(?:(?:one moment|please wait|just a moment|hold on|mohon tunggu|harap tunggu|tunggu sebentar|sebentar)[,.…]* *)?(?:(?:we are|we're|kami sedang)? ?(?:checking|verifying|memeriksa|memverifikasi) (?:your|if your|the security of your|that your)? ?(?:browser|connection|peramban|koneksi)(?: anda)?(?: is secure)?(?: before (?:you )?(?:proceed|continue|accessing|access)(?:ing)?.{{0,20}})?|peramban anda sedang diperiksa|koneksi anda sedang diperiksa)[ .…]*(?:\(?{_ID}\)?)?",
    rf"(?:please )?(?:verify|confirm|prove) (?:that )?you(?: are|'re) (?:a )?(?:human|not a robot)(?:[,. ]+(?:id|ref|code)?[:.]? *{_ID})?",
    rf"(?:verifikasi|pastikan|konfirmasi|buktikan) (?:bahwa )?(?:anda|kamu) (?:adalah )?(?:manusia|bukan robot)(?:[,. ]+(?:id|ref|kode)?[:.]? *{_ID})?",
    r"(?:one moment|please wait|just a moment|mohon tunggu|harap tunggu|loading|memuat)[ .…!]*",
]
# Words of a text that teaches placeholders, and what encloses code. A quote reaches to its closing mark in the line, an apostrophe within a word is none.
TUTORIAL = r"(?i)\b(?:template|templat|sintaks|syntax|placeholder|tutorial|variable|variabel|snippet|kode sumber|source code)\b"
CODE = r"(?isU)```.*?```|`[^`]*`|<(?:code|pre)\b.*?</(?:code|pre)>|\"[^\"\n]*+\"|(?<!\w)'(?:[^'\n]|(?<=\w)'(?=\w))*+'(?!\w)|“[^“”\n]*+”"

EMBEDDED = "|".join(f"(?:{g})" for g in GRAMMARS.values())
_SEP = r"[\s,.;:/|\-–—]"
# Words printed for missing values, filler and tests as one sentence of several kinds; words of two kinds need a mark between them ('Bar None' is a title).
_RUNS = "|".join(rf"(?:{run})(?=[^\S\r\n]*(?:[.!…:;,/|\-–—\r\n]|\z))" for run in (
    *(rf"{w}(?!\w)(?:{_SEP}++{w}(?!\w))*+" for w in (r"(?:undefined|null|none|nan|nil|\[object object\])", r"(?:asdf|qwerty|foo|bar|baz|blah|bla|xxx+|abc)")),
    rf"(?:testing|test|tes)(?!\w)(?:{_SEP}++(?:testing|test|tes|\d+)(?!\w))++", r"testing(?!\w)",
))
_SENTENCE = "|".join([*(f"(?:{s})" for s in STAND_INS), *(f"(?:{_OPEN}{e}{_TAIL})" for e in ERRORS), *(f"(?:{_OPEN}{n}{_TAIL})" for n in NOTICES), _RUNS])
_BETWEEN = r"[\s.!…:;,/|\-–—]"
# One sentence after another from the start of the field, however many: each follows the one before and is followed by another or the end.
SENTENCE = rf"(?isU)\A[\s\W&&[^\[{{<%$#@&]]*+(?:{_SENTENCE}){_BETWEEN}*+\z"
NEXT = rf"(?isU)\G(?:\A[\s\W&&[^\[{{<%$#@&]]*+)?(?:{_SENTENCE}){_BETWEEN}*+(?=\z|{_SENTENCE})"
PLACED = f"(?s)(?:{EMBEDDED}|{'|'.join(f'(?:{g})' for g in WHOLE_GRAMMARS)})"


def _only_words(t: Column) -> Column:
    """Whether the field is nothing but printed missing values, filler words, or several times 'test'."""
    found = let(F.regexp_extract_all(F.lower(t), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.struct(F.size(w).alias("n"), F.array_distinct(F.transform(w, lambda x: F.regexp_replace(x, "^x{3,}$", "xxx"))).alias("kinds")))
    all_in = lambda kinds, words: F.size(F.array_except(kinds, F.array(*map(F.lit, words)))) == 0
    plain = t.rlike(r"(?s)^[\w\s,.;:/|\-–—!\[\]]*$")

    def told(f: Column) -> Column:
        missing = all_in(f["kinds"], MISSING_WORDS) & (~F.array_contains(f["kinds"], "object") | t.rlike(r"(?i)\[object object\]"))
        return (f["n"] > 0) & (missing | all_in(f["kinds"], FILLER_WORDS) | ((f["n"] > 1) & all_in(f["kinds"], TEST_WORDS)))

    return plain & let(found, told)


def _only_sentences(t: Column) -> Column:
    """Whether the field is nothing but sentences of residue, of any number.

    Either each part between separators is one, or they follow one another, with
    separators within them. Each is looked at once, so time follows the length.
    """
    parts = F.array_distinct(F.filter(F.split(t, r"(?U)(?<=[.!?…:;,\n])\s+"), lambda x: x != ""))
    return (F.regexp_replace(t, NEXT, "") == "") | F.forall(parts, lambda x: x.rlike(SENTENCE))


# --- system messages by structure -----------------------------------------------------

# Words of system messages by their part in a sentence, in English, Indonesian, German, French, Spanish, Portuguese, Dutch and Italian.
PARTS = {
    # What a site, a script or a browser speaks of.
    "thing": "ip upstream json token tokens backend frontend cdn ssl certificate connections requests app application links contents data aplikasi konten anwendung inhalt application contenu aplicación contenido page pages url site website webpage server database connection resource file document host gateway proxy request response address link content session cookie cookies javascript js script scripts browser browsers captcha service network dns port api endpoint halaman laman situs server peladen basis koneksi permintaan berkas sumber tautan alamat layanan peramban skrip seite seiten webseite datei datenbank verbindung anfrage dienst serveur requête ressource fichier lien adresse connexion navigateur página pagina sitio servidor solicitud recurso archivo conexión navegador enlace dirección arquivo conexão pedido bestand verbinding verzoek risorsa richiesta connessione",
    # What went wrong with it.
    "fault": "bad disconnected unreachable unauthorized unsupported undeliverable outage error errors err fehler erreur erro errore fout galat kesalahan found 404 403 500 502 503 504 401 400 429 unavailable forbidden denied refused reset closed timeout timed failed failure fail fails unable cannot can't couldn't could unreachable reached invalid expired exist exists missing broken down offline maintenance overloaded busy blocked unauthorized permission interrupted aborted crashed exceeded unexpected internal wrong ditemukan ditolak gagal tersedia dihubungi diakses dimuat terputus kedaluwarsa diblokir gefunden verfügbar verweigert erreichbar fehlgeschlagen abgelaufen introuvable trouvée trouvé indisponible refusé échoué expirée encontrada encontrado disponible denegado falló expiró negado falhou indisponível niet gevonden beschikbaar geweigerd mislukt trovata trovato negato disponibile accesso accès acceso acesso zugriff toegang access akses",
    # What is said not to be.
    "not": "n'existe n'est no not no don't doesn't didn't isn't can't cannot couldn't unable never without tidak bukan belum nicht kein keine ne pas non n'est no não niet geen",
    # What the reader is told to do.
    "order": "necessary einschalten solve habilitar activar aktiviere erlauben autorisez permita checking verifying enabled disabled enabling required memerlukan membutuhkan completing complete activer aktiviert désactivé activado desactivado enable turn switch activate allow reload refresh retry try contact check verify confirm prove complete login log sign wait update upgrade disable please attention required requires require needs need must aktifkan nyalakan izinkan muat coba hubungi periksa verifikasi tunggu mohon silakan harap aktivieren bitte laden versuchen activez veuillez réessayez actualisez active habilite recargue intente por favor ative atualize tente schakel probeer attiva ricarica riprova",
    # What it is about, if the reader is told to do something.
    "means": "secure security javascript js script scripts scripting cookie cookies browser captcha robot robots human humans bot peramban skrip kuki manusia navigateur navegador ddos cloudflare noscript adblock adblocker",
    # Small words, places and times of such sentences.
    "small": "looks like reach reached fetch resolved resolve processed process full functionality we're you're it's there's we've diproses angeforderte zum vom beim interne interno interna del al para por con continuar cargar pudo pueden puede podemos existe existiert functionality work works properly quickly sent received read write written find working right out too many authorized longer bad followed follow resolution remote run action below above protection terjadi memiliki demandée order uses using used only once every time first give giving correct get getting got reason problem problems issue issues something anything nothing went came show shown display displayed display view reader visitors visit visiting again anymore yet still already make sure let make takes took long short days hours minute second jam menit detik hari sini kembali halaman telah ada oleh karena agar supaya hubungi wieder später einmal noch mehr nur nach von für ihren ihrem können kann konnten werden nous pouvons peut trouver charger plus tard cette merci algo salió mal más tarde nuevo intentar pode carregar kunnen laden the a an this that these your you our we it its to of on in for at by from with and or is are was were be been being has have had will may might if when while as so then now later again soon moment seconds minutes before after more some any all there here just also but looking requested requesting trying tried access accessing continue proceed proceeding view viewing see use using support supported supports establishing establish connecting connect processing process handling loading load opening open performing perform running security check checking verifying secure administrator admin webmaster owner support team id ref code ray trace status http https www com org net php html apache nginx ubuntu iis mysql sql was did does do which who what why because due occurred occur happened encountered temporarily permanently currently moved removed deleted renamed changed available main home homepage back go return sorry oops ups whoops maaf uh-oh hmm desired specified entered typed correct properly correctly yang ini itu di ke dari untuk pada dengan dan atau anda kami lagi nanti beberapa saat sedang telah sudah dapat bisa coba kembali beranda utama die der das den dem diese dieser dieses sie ihr ihre ist sind wurde wird werden konnte auf im in zu zur und oder es la le les l un une des du de est cette ce cet votre vous n'a été sur à et ou que qui el los las una su esta este ha sido en y o se lo está a os as o um uma na no em foi is het een deze dit uw u op en of lo gli questa questo è stata stato",
}
_OF = {w: set() for words in PARTS.values() for w in words.split()}
for _part, _words in PARTS.items():
    for _w in _words.split():
        _OF[_w].add(_part)


# Faults that are enough beside a thing.
STRONG = "failed failure denied refused unavailable timeout timed expired error errors interrupted closed invalid disconnected unreachable outage gagal ditolak terputus kedaluwarsa verweigert fehlgeschlagen abgelaufen fehler unterbrochen refusé refusée échoué indisponible introuvable erreur denegado falló expiró error inválida negado falhou indisponível erro geweigerd mislukt fout negato errore kesalahan galat"


def _words(of: list[str]) -> Column:
    """An array of words as one literal, which keeps the plan small."""
    return F.split(F.lit(" ".join(of)), " ")


def _in(words: Column, part: str) -> Column:
    """How many of the words have a part in system messages."""
    return F.size(F.array_intersect(words, _words(sorted(w for w, parts in _OF.items() if part in parts))))


#: A sentence that scores at least this is a system message: at most a tenth of its words are foreign to one.
MESSAGE = 0.9

def message_score(text: Column) -> Column:
    """How much a short text reads like a system message, from 0 to 1.

    The share of its distinct words that have a part in such messages (addresses,
    codes and numbers are left out), if it has the structure of one: a thing with
    a fault, a fault that is denied or has a code, or an order with the means that
    it asks for; else 0. Words of a story or a title's names lower the share.
    """
    bare = F.regexp_replace(F.lower(F.replace(text, F.lit("’"), F.lit("'"))), r"(?:https?://\S+|(?<!\S)/\S+|\b[\w-]+\.(?:com|org|net|example|php|html?|aspx?|id|jp)\b)", " ")

    def told(words: Column) -> Column:
        counted = F.filter(words, lambda w: ~w.rlike(r"^(?:\d+|[0-9a-f]{6,})$"))
        some = lambda part: _in(words, part) > 0
        code = F.exists(words, lambda w: w.rlike(r"^[45]\d\d$"))
        any_of = lambda text: F.arrays_overlap(words, _words(text.split()))
        # 'found', 'could' and their like say nothing alone: a strong fault, two, or one with a denial or a code.
        happened = (any_of("occurred occur happened encountered terjadi aufgetreten survenue produit ocurrido ocorreu") & any_of("error errors kesalahan galat fehler erreur erro problem")) | (any_of("something") & any_of("wrong"))
        faulty = happened | (some("thing") & some("fault") & (some("not") | code | (_in(words, "fault") >= 2) | any_of(STRONG))) | (some("thing") & some("not") & any_of("longer working isn't existe n'existe existiert connection verbindung")) | (some("thing") & any_of("many") & any_of("too")) | (code & (_in(words, "fault") >= 2))
        barred = (F.size(counted) >= 2) & any_of("access akses zugriff accès acceso acesso toegang permission authorized") & (some("not") & (F.size(counted) >= 3) | any_of(STRONG))
        told_to = some("means") & (F.size(counted) >= 3) & (some("order") | some("not") & any_of("available supported support enabled enable fault"))
        guarded = _in(words, "means") - F.when(any_of("robot robots human humans bot"), 2).otherwise(0) >= 2
        known = F.size(F.array_intersect(counted, _words(sorted(_OF))))
        return F.when((faulty | barred | told_to | guarded) & (F.size(counted) >= 2), known / F.size(counted)).otherwise(0.0)

    return let(F.array_distinct(F.regexp_extract_all(bare, F.lit(r"[\p{L}\p{N}]+(?:['-][\p{L}]+)*"), F.lit(0))), told)


#: What may be a system message at all; others are not scored.
_HINT = r"(?i)\b(?:went wrong|no longer|host|ip|api|javascript|java script|js|cookies?|captcha|browser|peramban|skrip|robot|human|cloudflare|server|serveur|servidor|database|datenbank|url|dns|gateway|page|pages|seite|página|pagina|halaman|site|website|situs|session|service|content|app|resource|ressource|link|permission|access|akses|zugriff|accès|acceso|acesso|toegang|error|errors|fehler|erreur|erro|errore|fout|galat|kesalahan|connections?|koneksi|verbindung|requests?|permintaan|[45]\d\d)\b"


def _only_messages(t: Column) -> Column:
    """Whether the field, or each sentence of it, scores as a system message."""
    parts = F.array_distinct(F.filter(F.split(t, r"(?<=[.!?…])\s+|\s+[|–—]\s+|[\r\n]+"), lambda x: x.rlike(r"\p{L}|\d")))
    return t.rlike(_HINT) & (F.size(parts) > 0) & ((message_score(t) >= MESSAGE) | F.forall(parts, lambda x: (message_score(x) >= MESSAGE) | x.rlike(SENTENCE) | x.rlike(r"(?i)^\W*(?:cloudflare|nginx|apache|(?:ray )?id\W+\w+)\W*$")))


def residue(text: Column) -> Column:
    """Whether a field is residue, or a real text with an unfilled placeholder in it. Null and blank are none."""

    def within(t: Column) -> Column:
        bare = F.regexp_replace(t, CODE, " ")
        left = F.regexp_count(bare, F.lit(EMBEDDED))
        shown = F.regexp_count(t, F.lit(EMBEDDED)) - left
        # In a tutorial, or where most placeholders are quoted, placeholders are the subject.
        return (left > 0) & (left >= shown) & ~((shown > 0) & t.rlike(TUTORIAL))

    def judged(t: Column) -> Column:
        blank = ~t.rlike(r"(?U)\S")
        placed = t.rlike(PLACED) & F.regexp_replace(t, PLACED, "").rlike(r"(?U)\A[\s.,;:\-–—/|]*\z")
        return ~blank & (placed | _only_words(t) | _only_sentences(t) | _only_messages(t) | (t.rlike(EMBEDDED) & within(t)))

    return F.coalesce(let(text, judged), F.lit(False))


def found(lines: DataFrame, fields: tuple[str, ...] = ("judul", "sinopsis")) -> DataFrame:
    """(line_id, fld): the fields of valid records that are residue; repeated lines give their rows again."""
    marks = F.array(*(F.struct(F.lit(f).alias("fld"), F.col(f"rec.{f}").alias("t")) for f in fields))
    return records(spread(lines)).select("line_id", F.inline(marks)).filter(residue(F.col("t"))).select("line_id", "fld")


def clean(lines: DataFrame, fields: tuple[str, ...] = ("judul", "sinopsis")) -> DataFrame:
    """(line_id, fields...): the valid records with residue kept out (null)."""
    return records(spread(lines)).select("line_id", *(F.when(~residue(F.col(f"rec.{f}")), F.col(f"rec.{f}")).alias(f) for f in fields))
