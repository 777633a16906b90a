"""Training text of the residue models: short passages written for this library.

NOTICES are error pages and demands for scripts, FILLER is text that stands in for content, PROSE
is natural technical writing, some of it about errors, scripts and templates. Hosts, paths, names
and numbers are left out, since they tell nothing about the class.
"""

from __future__ import annotations

NOTICES = """
404 not found. page not found. the page you are looking for could not be found. we could not find that page.
the page you requested does not exist. this page does not exist. the requested url was not found on this server.
the requested document has moved or no longer exists. return to the start page. go back to the home page.
we could not locate the file on this server. nothing was found at this address. this link may be broken.
403 forbidden. http error. you do not have permission to access this resource. access denied.
access to this site was denied. your reference is. access to this page has been denied. you are not authorized to view this page.
this repository does not exist or you lack permission to view it. you need permission to open this item.
please sign in to continue. you must be logged in to view this page. your session has expired.
500 internal server error. the server encountered an internal error and was unable to complete your request.
the upstream server closed the connection. an unexpected error occurred. please try again later.
502 bad gateway. 503 service unavailable. the service is temporarily unavailable. 504 gateway timeout. 429 too many requests. 410 gone.
the server is overloaded. error code. error id. request id. ray id. incident number.
traceback most recent call last. file line in render. template not found. unhandled exception. stack trace. application error.
bad gateway. please try again in some minutes. please come back in a while. we can not show this page right now. check the address and try again.
oops something went wrong. something went wrong on our side. sorry an error occurred. we are working on the problem.
the site is down for planned maintenance. we will be back soon. back in a few minutes. this site is currently offline.
this site can't be reached. the connection timed out. connection refused. too many requests. you have been rate limited.
please enable javascript to continue. enable javascript and cookies to continue. javascript is disabled in your browser.
javascript is required to view this page. this site requires javascript. you need to enable javascript to run this app.
this application needs javascript in order to run. turn it on and reload the page. this page cannot be shown.
you need a browser that runs scripts to view this page. if nothing appears your browser blocks scripts. loading please wait.
your browser does not support javascript. your browser is not supported. please upgrade your browser.
we use cookies and scripts. allow both to read this page. scripts and cookies must be allowed. please allow cookies.
this feature needs javascript. please enable javascript to view the comments. enable scripts to load the interactive demo.
noscript this viewer does not work without scripting. turn on scripting to see the content.
checking your browser before accessing the site. checking that your connection is secure. verify you are human. complete the captcha.
just a moment. one more step. ddos protection. attention required. unusual traffic from your network.
seite nicht gefunden. die angeforderte seite wurde nicht gefunden. diese seite existiert nicht. zur startseite zurück.
fehler der dienst ist zurzeit nicht erreichbar. interner serverfehler. ein fehler ist aufgetreten. bitte versuchen sie es später erneut.
zugriff verweigert. vorgang. sie haben keine berechtigung diese seite anzuzeigen. wegen wartungsarbeiten nicht verfügbar.
bitte aktivieren sie javascript um die seite anzuzeigen. diese anwendung benötigt javascript. javascript ist in ihrem browser deaktiviert.
die adresse gibt es nicht mehr. der gesuchte inhalt wurde verschoben oder gelöscht.
diese seite benötigt javascript und cookies. ihr browser blockiert skripte.
page introuvable. la page demandée n'existe pas. cette page est introuvable. retour à la page d'accueil.
erreur le service est indisponible. erreur interne du serveur. une erreur est survenue. veuillez réessayer plus tard.
cette adresse n'existe plus. le contenu recherché a été déplacé ou supprimé.
accès refusé. vous n'avez pas l'autorisation d'accéder à cette page. le site est en maintenance.
veuillez activer javascript pour afficher cette page. cette page a besoin de javascript. javascript est désactivé dans votre navigateur.
ce site nécessite javascript et les cookies. activez javascript pour continuer.
página no encontrada. la página solicitada no existe. no se encontró la página. volver al inicio.
error el servicio no está disponible. error interno del servidor. se ha producido un error. inténtelo de nuevo más tarde.
esta dirección ya no existe. el contenido buscado se ha movido o eliminado.
acceso denegado. no tiene permiso para ver esta página. el sitio está en mantenimiento.
active javascript para ver esta página. esta aplicación necesita javascript. javascript está desactivado en su navegador.
este sitio requiere javascript y cookies. habilite javascript para continuar.
"""

FILLER = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.
duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.
excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum.
vitae ornare turpis mauris donec risus augue porta felis ipsum lorem quis magna amet tempor velit aliqua sed nunc.
pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas vestibulum tortor quam.
feugiat ultricies eget mattis facilisis luctus vivamus suscipit pulvinar sagittis nulla facilisi cras integer.
heading one. heading two. subheading. paragraph one. paragraph two. section title. untitled. untitled document. new page.
coming soon. more content coming soon. this section is coming soon. details to follow. to be announced. to be written. to be determined.
under construction check back later. this page is under construction. work in progress. content pending. watch this space.
this page intentionally left blank. page left blank. no content yet. no content here yet. nothing here yet. empty page.
todo write this page. todo add content. todo fill in. tbd. add your text here. your text here. insert text here. write something here.
sample text goes here. replace this paragraph with a description of your product. this is placeholder text. dummy text. example text.
click here to edit this text. edit me. type your content here. description goes here. title goes here. replace me.
test test test asdf asdf qwerty. asdf asdf asdf. test 1 2 3. testing testing. this is a test page. hello world test page. foo bar baz foo bar. blah blah blah. xxx xxx xxx.
describe the project in two or three sentences. say who it is for. delete this hint. delete this line before publishing. remove this section.
write a short summary here. explain what it does and why. add a screenshot here. list the main features here. fill in the blanks.
the quick brown fox jumps over the lazy dog the quick brown fox jumps over the lazy dog.
inhalt folgt. demnächst verfügbar. diese seite ist im aufbau. platzhaltertext. hier steht ihr text. beispieltext hier einfügen.
contenu à venir. bientôt disponible. page en construction. texte de remplissage. votre texte ici. insérez votre texte ici.
próximamente. contenido en preparación. página en construcción. texto de relleno. su texto aquí. inserte su texto aquí.
"""

PROSE = """
set the limit to a higher value before you restart the service otherwise the worker drops its queue for a few minutes.
run the tool against the cluster to rebuild the index with more workers. keep the ratio below the ceiling.
the operator usually drains the node first and then rotates its certificate as soon as the probe passes.
when the collector reports a failing pod open the log file and restart the handler again. it took an hour until the cache was warm.
both services publish the same schema which moves the checkpoint behind the internal proxy. each partition carries many entries.
this controller belongs to the gateway and not to the scheduler so the runner flushes it while the lease is held.
store the fixture under the given path so that the script mounts it at the next sync. look at the configuration file for details.
without this setting a shared replica imports only part of the traffic. tests for the listener need about ten minutes.
nothing archives a snapshot faster than the new exporter with the budget set high. between two upgrades the daemon keeps its state.
our stream lost several requests during a rolling upgrade and the broker replayed the rest. the version moved the key into another file.
if the buffer stays full for long compress the archive by hand. unlike the old module this one validates every record within seconds.
you may resize or clone the volume the planner notices under sustained load. instead of one large batch give it a smaller window.
the function returns an error when the file is missing and the caller decides whether to retry. add a test for the failing case.
the server answers with status not found when the route is unknown and our client treats that as an empty list.
the crawler drops pages that only say please enable javascript so the renderer loads them in a headless browser.
see the site settings for the error pages. the proxy returns bad gateway until the upstream is healthy which takes a moment.
our renderer test fills the buffer with lorem ipsum of many words and compares the layout with the reference image.
the login form needs scripts because the token is signed in the browser and we render the rest on the server.
in a playbook the variable in braces is replaced by the value of the key when the template is rendered.
key default note. first second third. install usage options examples changelog added fixed removed changed.
wenn der dienst eine leere sicherung meldet prüfen sie zuerst die datei und danach den server. bitte setzen sie den wert höher damit keine abfrage verloren geht.
man kann die instanz löschen aber der dienst schreibt sie nach einigen minuten wieder. es genügt nicht die warteschlange zu leeren.
für jede partition legt der dienst genau einen eintrag an. seit dieser version liest das werkzeug die rolle aus einer anderen datei. danach übernimmt der nächste knoten.
ohne diesen wert bleibt die bereitstellung gesperrt und der lauf bricht ab. zwischen beiden diensten liegt eine schnittstelle die nur wenige anfragen zulässt.
quand l'outil signale une sauvegarde vérifiez d'abord le fichier puis le service. il faut régler la limite pour que le service ne perde aucune tâche.
on peut supprimer la file mais le service la recrée au bout de quelques minutes. depuis cette version l'outil lit la ressource dans un autre fichier.
pour chaque partition le service crée exactement une entrée dans le fichier. ensuite le relais reprend la requête et attend au plus une minute.
sans cette option la tâche reste bloquée et la commande échoue. vous devez aussi contrôler que le service garde la politique sous la limite.
si la herramienta informa de una copia revise primero el archivo y luego el servicio. hay que poner el valor más alto para que no se pierda ninguna cola.
se puede borrar la partición pero el servicio la vuelve a crear a los pocos minutos. desde esta versión la herramienta lee la política en otro archivo.
para cada consulta el servicio crea exactamente una entrada. después el nodo retoma la tarea y espera como máximo un minuto.
sin este valor la instancia queda bloqueada y la orden falla. también conviene comprobar que el servicio mantiene la puerta por debajo del límite.
"""

# Unfilled slots, made by a rule: notations of template languages filled with names and set in
# sentences; %n is a name with underscores, %w the same with spaces, %U and %W in capitals, %T in title case.
NOTATIONS = "{{ %n }}|{{%n}}|{{ %n.%n }}|{{%n.%n}}|[[%n]]|[[ %n ]]|<%= %n %>|<%= %n.%n %>|<% %n %>|{% %n %}|{% %n %n %}|@@%n@@|${%n}|${%n.%n}|#{%n}|%%%n%%|%%U%|__%U__|XXX%UXXX|[Insert %n here]|[INSERT %W]|[Your %T]|[your %w]|[Add %w]|[%W]|[%U]|<your-%n>|<%n-goes-here>|<%n here>|<%U>".split("|")
SLOT_NAMES = "name|year|team|owner|url|release_date|page_title|support_email|user_first_name|date2|x1".split("|")
SLOT_FRAMES = "%s|# %s|Ask %s for it.|The %s page, by %s|Welcome to %s!|See %s: more|mail (%s) or call|by %s, %s|**%s** is out|> %s".split("|")

# Marks in prose that are no slots.
MARKS = """
see [the guide](https://host.example/a-b/c_d?x=1) and [Part Two](../other/page.md#top) for more
![a picture](images/one.png) [![build](https://ci.example/badge.svg)](https://ci.example)
- [ ] open task
- [x] done task
as told in the note [1] and in [12], also [^3] and [see below]
[Guide]: https://host.example/guide
| name | value | default |
|------|:-----:|--------:|
use <br> or <br/> and <div class="note">text</div> with <b>bold</b> and <a href="https://host.example">links</a>
<https://host.example/path> <someone@host.example>
**bold text** and __strong__ and *one* and _two_ and ~~three~~
about 50 % of all, 20% more, 100%. It costs $5 or $10,000 (tax #3)
write to team@host.example, ask @someone, see #123 and issue #45
read {a, b, c} as a set; f(x) = {1, 2}; a[0] and list[i] or Map<String, Integer>
C# and F# and C++ run; a -> b; x => y; 3 < 4 and 5 > 4; a <= b
&nbsp; &amp; &lt; and [note] in brackets, {curly} too
# Heading {#anchor}
> quoted text with a [link][ref] inside
init is __init__ and a file is my_file__v2.txt
version 1.2.3 [stable] (2024-01-02) at 10:20:30
"""
