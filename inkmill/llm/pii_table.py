"""The labelled table from which the tagger of problem 10 is trained.

A sentence is a list of (text, type) parts, type None outside personal data. Sentences are put together by rule: a lead,
a value, a tail, each drawn on its own; values are filled in by rule from grammars of national forms. The wording was
written for this table. Names come from two short lists of many origins and from a rule that builds syllables.
"""

from __future__ import annotations

import random

from inkmill.llm.lang_samples import SAMPLES

TYPES = ("email", "phone", "id_number", "address", "name")
Part = tuple[str, str | None]

#: Names that the table is filled with (fixed values); half of them count as listed in each sentence.
GIVEN = """Anna Peter Mary Emma John Sarah Michael Laura Thomas Alice Henry Grace Oliver Chloe Ruth Walter Jean Marie Luc Camille Pierre Sophie Antoine Claire Hélène Étienne Hans Greta Jürgen
Heike Lukas Katrin Wolfgang Ursula Carlos María José Lucía Javier Pilar Álvaro Inés Giulia Marco Paolo Chiara Piotr Agnieszka Jakub Zofia Ivan Olga Dmitri Svetlana Björn Astrid Lars Ingrid
Mehmet Ayşe Emre Fatma Ahmed Layla Omar Yasmin Rajesh Priya Arjun Ananya Wei Mei Hiroshi Yuki Kenji Minjun Thi Kwame Amina Chidi Ngozi Tunde Zanele João Beatriz Tiago Siobhan Niamh Eoin""".split()
FAMILY = """Smith Jones Bridge Street Stone Garden Baker King Young Wood Hill Brown Green White Taylor Walker Hughes Murphy O'Connor MacDonald Dubois Lefèvre Moreau Girard Roux Petit Müller Schmidt
Weber Fischer Becker Schäfer Köhler García López Fernández Ruiz Ortega Vega Torres Rossi Bianchi Esposito Kowalski Nowak Wiśniewski Petrov Ivanova Sokolov Larsen Johansson Nyström Hansen
Yılmaz Kaya Demir Haddad Mansour Khalil Patel Sharma Singh Iyer Chen Wang Zhang Liu Tanaka Suzuki Watanabe Kim Park Tran Pham Okafor Mensah Adeyemi Dlamini Nkosi Silva Santos Oliveira Costa
Novák Horváth Popescu Rivers Marsh Fox Day Winter Church Mills Banks Field""".split()
#: Family names that are also parts of place names: they come with a given name of the list, as a made-up word before them is
#: mostly a place.
PLACES = frozenset("Bridge Street Garden Hill Park Church Mills Banks Field Marsh Rivers Green Wood".split())
PARTICLES = ("de la", "von", "van der", "de", "di", "del", "van", "zu", "dos", "le", "al", "bin", "ben", "Mac", "St.")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Mr.", "Mrs.", "Dr.", "Prof.", "Professor", "Sir", "Captain", "Herr", "Frau", "Herrn", "M.", "Mme", "Madame", "Monsieur", "Sr.", "Sra.", "Señor", "Señora", "Don", "Doña", "Judge", "Nurse")

#: What stands before a value, by type: in prose, in forms and in markup.
LEADS = {
    "name": """Written with care by |Met |Yours in haste, |Booked for |Guest: |Interview with |as told to |Kind wishes from |The landlord is |The witness, |My cousin |Patient |Lodger: |Signed, |Editor: |applicant = |Neighbour |The tailor |The widow |A friend, |A letter by |The house of |The wife of |Cousin |Painter |Uncle of |Will |Did |Has |Was |Can |We saw |We missed |She kissed |They hid |He hired |I buried |We found |You know |the twins of |<b>|"owner": "|owner;
He had married |They voted for |I spoke to |We owe it to |portrait of |a letter from |Ask for |according to |care of |Best man: |Sender: |on behalf of |In memory of |Payee |To |Attn. |cc: |Chair: |- |* |1. |– |photo: |Music: |Text: |with |and |by |
Signé : |Rédigé avec |La patiente, |chez |Demandez |J'ai vu |Le gérant est |Votre voisin |La nièce de |Le peintre |Le boulanger |Le livre de |La mère de |Une lettre de |Notre cousin |On a vu |J'aime |Hier, |Photos de |signature : |rencontre avec |selon |Auteur : |Destinataire : |avec l'aide de |pour |par |à |
Gezeichnet: |Verfasst mit |Der Mieter heißt |bei |Fragen Sie |Nachbar |Der Müller |Die Wirtin |Der Schneider |Die alte Frau |Das Buch von |Ein Brief von |Die Mutter von |Der Garten von |Der Bäcker |Onkel |Meine Schwester |Der Kollege |Heute kam |Dann ging |Das Haus von |Gestern sah |Ich traf |Gruß von |laut |Fotos von |Empfänger: |im Namen von |Vorsitz: |Autorin: |für |mit |an |von |durch |Gemalt von |Erzählt von |Gedruckt von |Bearbeitet von Herrn |Gebaut von |Komponiert von |Gespielt von Frau |Ein Werk von |Übertragen von |Aus dem Englischen von |Bezahlt von |Geprüft von |Gelesen von |
Firmado: |Redactado con |La clienta, |en casa de |Pregunte a |Vi a |El dueño se llama |El vecino |La prima |El sastre |El libro de |La madre de |Una carta de Ayer vi a |La casa de |El pintor |Hoy vino |según |Fotos de |Destinatario: |en nombre de |Preside: |Autora: |para |con |a |por |de """,
    "phone": """Tel. |tel: |Telephone |Mobile |mob. |Cell: |Fax |phone |Ring |Dial |Try |my number is |Our line is |WhatsApp |Hotline: |Call |call us on |or by phone, |answers at |text me at |"phone": "|phone;|T |☎ |Number: |leave word on |reach me at |
Tél. |Tél : |Portable |Composez |mon numéro : |Joignable au |au |Fax : |appeler |par téléphone au |Mobile : |
Tel.: |Telefon |Handy: |Mobil |unter |Rufnummer |Wählen Sie |erreichbar unter |Fax: |anrufen: |meine Nummer ist |
Tfno. |Tel: |Móvil |Marque |mi número es |al |llamar al |por teléfono, |Fax: |contacto: """,
    "email": """Mail |mail: |E-mail: |email |Email |e-mail = |my address is |Drop a line to |Send it to |contact |forward it to |via |to |<mailto:|"mail": "|mail;|Inbox: |From: |Reply-To: |cc |replies go to |reached at |
Courriel : |écrire à |par mail à |Mél. |adresse : |à |réponses à |Envoyez-le à |
Mail an |E-Mail: |schreiben an |per Mail: |Adresse: |Antworten an |Schick es an |an |
Correo: |correo |escribir a |por correo a |dirección: |a |Mándelo a |respuestas a """,
    "id_number": """(ID |ID |ID: |tax ID (|IdNr. (|NIF (|SSN (|n° (|identity: |proof of identity, |personal number: |insured under number |insurance: |her tax number, |tax: |national no. |no. |identity no |SSN |SSN: |NI number |NINO: |Tax ID |tax reference |insurance no |Insurance number: |id: |ID no. |id = |"ssn": "|ssn;|identity card |national ID |soc. security |passport-free id |under the tax number |his social security number was |the taxpayer number |registered as |number for tax: |
numéro de sécurité sociale |NIR : |n° fiscal |NIF |carte d'identité n° |assuré sous le numéro |identifiant : |sécu : |numéro fiscal : |mon numéro fiscal est le |son NIR est le |le numéro est le 
Steuernummer |Steuer-Identifikationsnummer: |IdNr. |Sozialversicherungsnummer |SV-Nummer: |Ausweis |Personalnummer beim Finanzamt: |Versichertennummer |meine Steuernummer ist |
DNI |DNI: |NIE |NIF: |con DNI |número de la seguridad social |identificación fiscal |documento n.º |mi número fiscal es el |su NIF es el mi DNI es |NSS """,
    "address": """lives at |lived at |of |Address: |address = |Office: |Visit us at |The shop at |moved to |deliver to |ship to |Mail to: |"street": "|street;|the flat at |corner house, |a room at |at |from |Home: |by post: |born at |Studio, |turn up at |Party |Meeting |Dinner |Pick-up |She sold |He bought |we rent |
demeurant |habite au |au |adresse : |domicilié |Bureau : |Livrez au |chez nous, |Fête |Dîner |Elle vend |on loue |Rencontre |à la maison du |le magasin du |
wohnhaft |wohnt |Anschrift: |Adresse: |in der |Büro: |Liefern an |zu Hause in der |Treff |Lager |Fest |Abholung |Zimmer |nach |Wir mieten |Werkstatt |die Wohnung |Laden: |
domiciliado en |vive en |dirección: |Domicilio: |en la |Oficina: |Entregar en |el piso de |Cena |Fiesta |Cita |Taller |se vende |Recogida la tienda de |con casa en """,
}
#: What stands after a value.
TAILS = """.|.|.|,|;|:|!|?|</b>|"|",|)|
| said so.| is away.| was there.| has the key.| agreed, and that was that.| (home)| (work)| or later.| only.| before noon.| after six.| please| thanks.| and wait.| by then.| today.|, second floor.|, near the park.| — urgent| / office| | private|, London.|, then.|, room 4.
| est absente.| a signé.| s'il vous plaît.| avant dix heures.| le soir.|, merci.|, Lyon.|, deuxième étage.| (bureau).
| ist verreist.| hat unterschrieben.| bitte.| vor zehn Uhr.| abends.|, danke.|, Köln.|, zweiter Stock.| (privat).
| está fuera.| ha firmado.| por favor.| antes de las diez.| por la noche.|, gracias.|, Sevilla.|, segundo piso.| (trabajo).""".replace("\n", "|").split("|")
#: Whole sentences with several values; a | without blanks ends a line.
SEVERAL = """{name}
{name}.
{place}|{name}
{name}|{address}
{name}|{phone}
{name}|{address}|{phone}|{email}
{address}|{phone}
{name} <{email}>
{name} ({email}), {name} ({email})
{name}, {address}
{name} - {phone}
{name}; {id_number}; {address}
{name} and {name} moved in last spring.
{name}, {name} and {name} took turns.
{name} & {name}
{name}, {name}
Owners: {name}, {name}
Guests: {name}, {name}
Cast: {name}, {name}, {name}
{name}, {name}, {name}
Mit {name}, {name} und {name}
Players: {name}, {name}, {name}
Besides {name}, {given} was there.
{name} {phone} {email}
{name} | {phone} | {email}
name;phone;email;id|{name};{phone};{email};{id_number}
tel={phone}&mail={email}&ssn={id_number}
user={name},tax={id_number}
{{"n": "{name}", "t": "{phone}", "m": "{email}", "i": "{id_number}", "a": "{address}"}}
["{name}", "{phone}"]
["{email}", "{id_number}"]
<li>{name}</li><li>{phone}</li>
<p>{name}, <i>{address}</i></p>
<a class=m href='mailto:{email}'>{name}</a>
IMPRINT|{name}|{address}|{phone}
OWNER|{name}|{address}
Studio|{name}|{address}|{phone}
Agent|{name}|{address}|{email}
TERMS.|{name}|{address}|{phone}
{d1}.|DETAILS|{name}|{address}
SENDER|{name}|{address}|{email}
Coordonnées|{name}|{address}|{phone}
Impressum|{name}|{address}|{phone}|{email}
Datos|{name}|{address}|{phone}
{place}|{name}|{address}|{email}
{title} {name}, of {address}, is the tenant.
{name} schläft in der Stadt {place}, {address}, im Keller.
Der Wirt {name} ({phone}) und die Wirtin {name}
In {place}, {address}, starb {name}.
À {place}, {address}, mourut {name}.
En {place}, {address}, murió {name}.
{title} {name} has number {id_number} with the revenue.
{title} {name} asked {title} {name} to wait.
Either {phone} or {email} will find me.
Neither {email} nor {phone} works now.
Send {id_number} and {phone} to {email}.
Keep {id_number} secret, {given}.
{given} gave me {phone}; {given} wants {email}.
I, {name}, sell the boat to {name}.
{name}: {email}
{name}'s house, {address}, is for sale.
{email}, {phone}
{phone} / {phone}
{id_number} / {id_number}
{id_number}, {name}
{phone}, ask for {name}
{title} {name} demeure {address} depuis mai.
{name} et {name} sont mariés.
{title} {name} wohnt jetzt {address}, oben.
{name} und {name} sind verlobt.
{title} {name} vive ahora en {address}, arriba.
{name} y {name} son socios.
Contact me - {name} - under {phone}.
Regards,|{name}
Cordialement,|{name}|{phone}
Viele Grüße|{name}|{email}
Un saludo,|{name}|{address}
""".strip().split("\n")

#: Sentences without personal data: numbers of other kinds, single names, titles, headings, places and capitals.
NONE = """Flight {d2}{d2} leaves at {d2}:{d2} from gate {d2}.
The score stood at {d2}-{d2} after {d2} minutes.
In {year} and again in {year} the dam broke.
From {year}-{d2}-{d2} until {d2}.{d2}.{year} we were closed.
{d2}/{d2}/{year}
Between {year}-{year}, see pages {d3}-{d3}.
It measured {d2}.{d2} by {d3}.{d1} metres.
Total: {d1},{d3}.{d2}
Price {d2}.{d2}, was {d3}.{d2}
ISBN {d3}-{d1}-{d4}-{d4}-{d1}
ISBN {d1}-{d3}-{d5}-{d1}
ISSN {d4}-{d4}
Item {d4}-{d4}-{d4} is out of stock.
Shelf {d4}-{d4}-{d4}
Ref. {d4}-{d4}-{d4}, box {d2}
No. {d5}-{d3}-{d2} in the register of ships
Archive number {d2} {d2} {d2}, reel {d1}
Mark AB {d2} {d2}, second row
Parcel {d7} went by sea.
Invoice {d7} is paid.
Order no. {d5}{d3} was cancelled.
Ticket #{d7}
#{d5}
Page {d3} of {d3}
Chapter {d2}, verse {d2}
Vol. {d2}, no. {d1}, pp. {d3}–{d3}
Version {d1}.{d2}.{d1} replaced version {d1}.{d1}.{d2}
{year}-{d2}-{d2}T{d2}:{d2}:{d2}
Bus {d3} stops in Bay {d2} at {d2}.{d2}.
Temperatures between {d1} and {d2} degrees
1, 2, 3, 4, 5
{d2} apples, {d2} pears and {d3} plums
Psalm {d3}:{d2}
Set in {d2} point, {d2} lines a page.
Rated {d1}/{d2} by {d3} visitors
@{word}{d2} posted it
follow @{word} or @{word}_{d2}
Look at me, look at 5, look at her.
we met at {place} at noon
Room at the top, number {d2}
{given} sat down.
{given} and {given} went out with {given}.
{given}, {given} and {given}
"Where is {given}?" asked {given}.
{given}: Who is there?|{given}: Nobody.
Dear {title} {family},
{title} {family} and {title} {family} nodded.
Old {family} laughed at young {given}.
Then {given} Who Sings came along.
Uncle {given}, Aunt {given} and the Mayor
The {family} family had left {place}.
The {family} House on {place} Square
{place} Bridge and {place} Station
{place} University Press
{family} College, {family} Hall and the {family} Medal
The {family} Foundation
{family} Avenue was dark.
{place} Street stays dark.
{place} Street, {place} Road and {place} Bridge
The cart crossed {place} Bridge. {place} Street slept.
{place} Church, {place} Hill, {place} Park
{place} Institute and {place} Prize
OÙ VA LE {NOUN}? LE {NOUN} A PARLÉ.
DER {NOUN} UND DIE {NOUN}
on {place} Road, by night
along {place} Lane
the {adj} {noun} of {place}
The {Adj} {Noun}
The {Adj} {Noun} and Other Poems
{Adj} {Noun} {Noun}
A {Noun} for {given}
{given} and the {Noun}
# The {Noun} of {Place}
{d2}. {Adj} {Noun}
{GIVEN} RAN AND {GIVEN} FELL.
THE {NOUN} OF {PLACE}
NO {NOUN}, NO {NOUN}!
Monday, Tuesday and Good Friday
North Sea, South America, New Year
United States Senate, House of Lords
Part {d1}: {Noun} and {Noun}
Thank You Very Much
My {Noun}, My {Noun}
Act {d1}, Scene {d2}
Alors {given} se tut.
Puis {given} revint avec {given}.
Tante {given} et le Docteur {family}
Le Petit {Noun}
La rue de {place} était vide.
Cher {given},
page {d3}, ligne {d2}, en {year}
il y avait {d3} chaises et {d2} tables
Dann schwieg {given}.
Am Abend kam {given} mit {given} zurück.
Der Lehrer {family} und die Tante {given}
Das Alte Haus in {place}
Auf der Treppe stand {given}.
Die {place}er Straße war leer.
Lieber {given},
Seite {d3}, Zeile {d2}, im Jahr {year}
es waren {d3} Stühle und {d2} Tische
Im Jahr {year} und im Winter {year} blieb es still.
Im Abschnitt {d3} steht nichts davon, am Ende auch nicht.
Am Morgen lagen auf dem Tisch {d2} Bücher.
Auf dem Berg und im Tal, am Ufer und an der Mauer wuchs Gras.
Wenn der Hund am Tor bellt, steht {given} auf.
Im Kasten {d2} und im Schrank {d3} war {noun} Nr. {d2}.
Zur Zeit {given}s kam am Montag um {d2} Uhr der Zug {d3}.
Dans le salon {d2}, au rang {d3}, il fait froid.
au chapitre {d2}, sur la place, {given} attend
En la sala {d2}, en la fila {d3}, hace frío.
el capítulo {d2} habla de {given}
In part {d3} the {noun} meets the {noun}, and {given} waits.
Im Heft {d3} und im Kurs {d2} malte der Schüler ein Pferd.
Im Vers {d2} ruft die Mutter. Im Lied {d3} tanzt der Bauer.
Zum Preis von {d2} Mark kaufte {given} die Kuh.
Am Gleis {d2} wartet der Zug, in dem die Gräfin sitzt.
Im Mai {year} war der Garten schön, den der Doktor sah.
Im Spiel {d3} verlor der Junge das Messer, was {given} freute.
Im Stück {d2} lügt der Kaiser, so leise wie ein Kind.
Im Lager {d3} zählte der Soldat die Schuhe, die {given} brauchte.
{d2}. {place} Street lay still.
{d2}. {family} Road is closed.
{d1}. {place} Lane
{d2}. Der Fischer holte das Netz, das unter dem Boot lag.
{GIVEN}: When {given} came, it rained.
{GIVEN}: If {given} only knew!
{GIVEN}: Und {given}?
{GIVEN}: Warum schweigt {given}?
{GIVEN}: Quand {given} parle, on rit.
{GIVEN}: Cuando {given} canta, llueve.
WHO SAW {GIVEN} IN THE {NOUN}?
« JE PARS », DIT {GIVEN}.
ICH SAH {GIVEN} AM TOR.
When {given} slept, the {noun} moved, and {given} laughed.
When {given} sold the {noun}, nobody spoke.
If {given} asks, say no. When {given} asks, say yes.
Chère {given}, cher {given},
Mein lieber {given}, meine {given}!
Points: {d2}-{d2}-{d2}.
Tally: {d2}-{d2}-{d2}
won {d2}-{d2}-{d2} in the end.
{Noun}, {Noun}, {noun}
Salt, Bread and {Noun}
Miete, Zins, Steuer
Rente, Nummer {d2}
{d3} g {noun}, {d2} g {noun}, {d1} cups of {noun}
{d2} km and {d3} m, {d2} cm wide
Am {d2}. Mai {year} fiel Schnee, am {d1}. Juni nicht.
Im Band {d2} fehlt ein Blatt.
Im Bild {d2} sieht man {given}.
Im Zimmer {d2} schlief der Diener, im Zimmer {d3} die Frau.
Im Akt {d1} stirbt {given}.
Am Tag {d2} kam {given}.
{blob}
{blob} {blob} {blob}
id-{blob}
{word}{d2}{word}
Nach der Arbeit ging {given} heim.
Unter der Brücke schlief {given} neben dem Hund.
Vor dem Fest sang die Tante, nach dem Essen der Onkel.
Aus der Ferne rief {given}.
Dans la Ville de {place}
Read pp. {d3}-{d3} tonight.
pp. {d3}-{d3}, p. {d3}
Result {d2}-{d2}-{d2}, rank {d1}
Sets {d1}-{d1}, {d1}-{d1}, {d2}-{d2}
Code {d4}-{d4}
Number {d4}-{d4}-{d4}-{d4}
Stock 00{d2}-{d4}-{d4} came back.
Plate 00{d2}-{d4}-{d4}, folio {d2}
Batch {d2}-{d4}-{d4}
ISBN 978-{d1}-{d4}-{d3}-{d1}, reprinted
ISBN 979-{d2}-{d4}-{d2}-{d1}
ISBN 978-{d1}-{d4}-{d3}-{d1}
ISBN {d1}-{d4}-{d4}-{d1}, bound
Round {d2}-{d2}-{d2}
Der Bäcker lobte die Kunst, der Schmied das Wetter und der Koch den Wein.
Ein Brief für die Tochter des Königs lag auf dem Tisch.
Entonces calló {given}.
Luego {given} volvió con {given}.
La tía {given} y el Doctor {family}
La Casa Vieja de {place}
La calle de {place} estaba vacía.
Querida {given}:
página {d3}, línea {d2}, año {year}
había {d3} sillas y {d2} mesas
Ever so gently, {given} turned.
Perhaps {given} knew. But {given} slept.
However {given} tried, it failed.
Only {given} heard it
When {given} wept, {place} wept.
Because {given} said so.
Yes, {given}. No, {given}.
{given}!
{given}, come here
'{given},' he said
Grandmother {given} told {given} of the {noun}.
Saint {given} and Pope {given}
King {given} the {Adj}
in the year {year} of King {given}
{d2} years later, {given} wrote {d2} letters.
by {given}
(by {given}, aged {d1})
Your {given}
Love,|{given}
""".strip().split("\n")
ADJECTIVES = "silent golden broken northern bitter lonely winter hollow scarlet patient secret paper".split()
NOUNS = "fox lantern orchard river shadow feather island clock candle mirror garden mountain winter stranger song".split()

_ONSETS = "b bl c ch d dr f g gr h j k l m n p pl r s sh st t tr v w z".split()
_VOWELS = "a e i o u aa ai au ea ee ia ie io oa ou ue".split()
_CODAS = ["", "", "n", "r", "l", "s", "k", "m", "th", "nd", "rk", "x", "lm", "sk"]


class Filler:
    """Fills in values by rule from a seeded generator."""

    def __init__(self, seed: int, given: list[str] = GIVEN, family: list[str] = FAMILY) -> None:
        self.r = random.Random(seed)
        self.names = (given, family)
        self.invented: set[str] = {n.lower() for n in (*given, *family)}

    def one(self, *of: str) -> str:
        return self.r.choice(of)

    def word(self, syllables: int) -> str:
        w = "".join(self.one(*_ONSETS) + self.one(*_VOWELS) + self.one(*_CODAS) for _ in range(syllables))
        self.invented.add(w)
        return w.capitalize()

    def digits(self, n: int) -> str:
        return "".join(self.one(*"0123456789") for _ in range(n))

    def groups(self, n: int) -> list[str]:
        """n digits in groups of two to four, now and then in one."""
        if self.r.random() < 0.2:
            return [self.digits(n)]
        size, out = self.r.choice((2, 3, 4)), []
        while n > 0:
            k = n if n - size < 2 else size
            out.append(self.digits(k))
            n -= k
        return out

    def given(self) -> str:
        return self.word(self.r.randint(2, 3)) if self.r.random() < 0.5 else self.one(*self.names[0])

    def family(self) -> str:
        return self.word(self.r.randint(1, 3)) if self.r.random() < 0.5 else self.one(*self.names[1])

    def name(self) -> str:
        r, g, f = self.r, self.given(), self.family()
        if f in PLACES:
            g = self.one(*self.names[0])
        if r.random() < 0.1:
            g = f"{g}-{self.given()}"
        elif r.random() < 0.12:
            g = f"{g} {self.given()}"
        if r.random() < 0.12:
            g = f"{g} {self.one(*'ABCDEFGHJKLMNPRSTVW')}."
        if r.random() < 0.08:
            f = f"{self.one(*PARTICLES)} {f}"
        elif r.random() < 0.08:
            f = f"{f}-{self.family()}" if r.random() < 0.6 else f"{f} {self.family()}"
        s = f"{f}, {g}" if r.random() < 0.12 else f"{g}{self.one(' ', ' ', ' ', ' ', '  ', chr(160))}{f}"
        return s.upper() if r.random() < 0.12 else s

    def email(self) -> str:
        r, g, f = self.r, self.given().lower(), self.family().lower()
        local = self.one(f"{g}.{f}", f"{g}-{f}", f"{g}_{f}", f"{g[0]}{f}", f"{f}.{g[0]}", f"{g}{self.digits(2)}", f"{f}{self.digits(2)}", f"{g}+{self.word(1).lower()}", f"{f}_{g[0]}", g, f, "info", "office", f"{g[0]}.{f}{self.digits(1)}", f"{f}-{g}")
        at, dot = self.one(("@", "."), ("@", "."), ("@", "."), ("@", "."), (" @ ", "."), (" at ", " dot "), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" AT ", " DOT "), ("{at}", "."), (" at ", "."))  # type: ignore[misc]
        host = self.word(2).lower() + self.one("", "", "", "-" + self.word(1).lower(), self.digits(1))
        host = self.one("", "", "mail.", "web.", self.word(1).lower() + ".") + host
        end = self.one("com", "org", "net", "info", "example", "test", "invalid", "de", "fr", "es", "co.uk", "edu")
        s = f"{local}{at}{(host + '.' + end).replace('.', dot)}"
        return s.upper() if r.random() < 0.07 else s

    def phone(self) -> str:
        r, d, sep = self.r, self.digits, self.one(" ", " ", "-", ".", "")
        area = self.one(d(2), d(3), d(4), d(3))
        body = sep.join(self.groups(r.randint(6, 8)))
        join = sep or self.one(" ", "/", "-", "")
        kind = r.random()
        if kind < 0.3:
            return f"{self.one('+', '+', '00')}{self.one('1', '44', '49', '33', '34', '39', d(2), d(3))}{self.one(' ', ' ', '-', '')}{self.one('', '', '(0)', '(0) ')}{area}{join}{body}"
        if kind < 0.55:
            return f"0{area}{self.one(' ', '/', '-', ' / ', join)}{body}"
        if kind < 0.7:
            return f"({self.one('', '0')}{area}){self.one(' ', ' ', '', '-')}{body}"
        if kind < 0.8:
            s = self.one(" ", ".", "-")
            return s.join([self.one("0", "9", "6") + d(1), d(2), d(2), d(2), d(2)])
        if kind < 0.9:
            s = self.one(".", "-", "-", " ")
            return f"{self.one('', '', '1' + s, '+1 ')}{d(3)}{s}{d(3)}{s}{d(4)}"
        return self.one(f"{self.one('6', '7', '9')}{d(2)}{sep}{d(3)}{sep}{d(3)}", f"0{d(2)} {d(8)}", f"0{d(3)} {d(6)}", f"0{d(4)}-{d(6)}", f"0{d(2)} {d(4)} {d(4)}", f"0{d(2)} {d(5)}-{d(2)}", f"9{d(1)} {d(3)} {d(2)} {d(2)}", f"9{d(2)} {d(3)} {d(3)}", f"9{d(2)} {d(2)} {d(2)} {d(2)}")

    def id_number(self) -> str:
        d, letter = self.digits, lambda: self.one(*"ABCDEFGHJKLMNPQRSTVWXYZ")
        two = self.one("QQ", letter() + letter(), letter() + letter())
        return self.one(
            f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}", f"{two} {d(2)} {d(2)} {d(2)} {self.one(*'ABCD')}", f"{two}{d(6)}{self.one(*'ABCD')}", f"{d(2)} {d(3)} {d(3)} {d(3)}", f"{d(11)}", f"{self.one('0', d(1))}{d(10)}",
            f"{d(8)}{letter()}", f"{d(8)}-{letter()}", f"{self.one(*'XYZ')}-{d(7)}-{letter()}", f"{self.one(*'XYZ')}{d(7)}{letter()}", f"{self.one(*'12')} {d(2)} {d(2)} {d(2)} {d(3)} {d(3)} {d(2)}", f"{self.one(*'12')}{d(14)}", f"{d(2)} {d(6)} {letter()} {d(3)}", f"{d(2)}{d(6)}{letter()}{d(3)}", f"{d(3)}/{d(3)}/{d(5)}",
        )

    def address(self) -> str:
        r, p = self.r, self.one(self.word(2), self.word(2), self.family(), self.one(*NOUNS).capitalize(), self.given())
        n = str(r.randint(1, r.choice((9, 40, 300))))
        no = self.one(n, n, n, n + self.one(*"ABCabc"), f"{n}-{int(n) + 2}", f"{n}/{r.randint(1, 9)}")
        kind = self.one("en", "en", "en", "fr", "fr", "de", "de", "de", "es", "es")
        if kind == "en":
            p = self.one("", "", "", "N. ", "Old ", "Upper ", "St. ", "West ") + p + self.one("", "", "", " " + self.one(*NOUNS).capitalize())
            end = self.one(*"Street Street Road Road Lane Avenue Drive Close Court Way Grove Place Terrace Crescent Gardens Hill Row Walk Mews Square Park Boulevard Green Rise View Parade Quay St St. Rd Rd. Ln Ave Ave. Blvd Dr.".split())
            return f"{self.one('', '', '', 'Flat 2, ') if r.random() < 0.2 else ''}{no}{self.one(' ', ' ', ' ', ', ')}{p} {end.upper() if r.random() < 0.1 else end}"
        if kind == "fr":
            way = self.one(*"rue rue rue avenue boulevard place quai allée chemin impasse cours passage square route".split())
            return f"{n}{self.one('', '', ' bis', ' ter', ',', ',')} {way.capitalize() if r.random() < 0.15 else way} {self.one('', '', 'de la ', 'des ', 'du ', 'de ', 'Saint-')}{p}"
        if kind == "de":
            if r.random() < 0.3:
                return f"{self.one('Am', 'Am', 'An der', 'Auf dem', 'Zum', 'Zur', 'Unter den')} {p} {no}"
            end = self.one(*"straße straße straße strasse str. weg gasse platz allee ufer ring damm steig".split())
            return f"{p}{end} {no}" if r.random() < 0.8 else f"{p}{self.one('er', '-', ' ')}{self.one(' ', '') if r.random() < 0.3 else ''}{end.capitalize()} {no}"
        way = self.one(*"Calle Calle Calle C/ Avenida Avda. Plaza Paseo Camino Ronda Travesía calle avenida plaza".split())
        return f"{way} {self.one('', '', 'de la ', 'del ', 'de ', 'San ')}{p}{self.one(' ', ', ', ', n.º ', ' nº ', ' núm. ')}{no}"

    def fill(self, pattern: str) -> list[Part]:
        out: list[Part] = []
        pattern = pattern.replace("{{", "\x00").replace("}}", "\x01")
        while pattern:
            head, _, rest = pattern.partition("{")
            if head:
                parts = head.replace("\x00", "{").replace("\x01", "}").split("|")
                line = parts[0]
                for a, b in zip(parts, parts[1:]):
                    line += ("|" if a.endswith(" ") and b.startswith(" ") else "\n") + b
                out.append((line, None))
            key, _, pattern = rest.partition("}")
            if key in TYPES:
                out.append((getattr(self, key)(), key))
            elif key:
                out.append((self._plain(key), None))
        return out

    def _plain(self, key: str) -> str:
        low = key.lower()
        if low[0] == "d" and low[1:].isdigit():
            return self.digits(int(low[1:]))
        if low == "year":
            return self.one("17", "18", "19", "20") + self.digits(2)
        if low == "blob":
            return "".join(self.one(*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789/+") for _ in range(self.r.randint(12, 60)))
        made = {"given": self.given, "family": self.family, "place": lambda: self.word(2), "word": lambda: self.word(2).lower(), "title": lambda: self.one(*TITLES), "adj": lambda: self.one(*ADJECTIVES), "noun": lambda: self.one(*NOUNS)}[low]()
        return made.upper() if key.isupper() else made.capitalize() if key[0].isupper() else made

    def single(self, kind: str) -> list[Part]:
        """A lead, a value and a tail."""
        lead, tail = self.one(*LEADS[kind].replace("\n", "|").split("|")), self.one(*TAILS)
        if kind == "name" and self.r.random() < 0.2:
            lead += self.one(*TITLES) + " "
        if self.r.random() < 0.1:
            lead = lead.upper()
        elif self.r.random() < 0.1:
            lead = lead.rstrip()
        return [(lead, None), (getattr(self, kind)(), kind), (tail, None)]


def labelled_table(seed: int = 11, singles: int = 600, rounds: int = 10) -> tuple[list[list[Part]], set[str]]:
    """Sentences with their parts, and all name words in lower case."""
    f = Filler(seed)
    plain = [s.strip() for text in SAMPLES.values() for s in text.split("\n") if s.strip()]
    around = [x.strip() for p in plain for x in p.replace("?", ".").split(". ") if 2 < len(x.split()) < 14]
    lines: list[list[Part]] = []
    for kind, share in (("name", 2.2), ("phone", 1), ("email", 0.8), ("id_number", 1.3), ("address", 1.3)):
        lines += [f.single(kind) for _ in range(int(singles * share))]
    for _ in range(rounds):
        lines += [f.fill(p) for p in SEVERAL]
    lines += [f.fill(p) for _ in range(rounds + 2) for p in NONE]
    out = []
    for s in lines:
        s = [p for p in s if p[0]]
        if f.r.random() < 0.3:
            s = [(f.one(*around) + f.one(". ", ".\n", ", "), None), *s]
        if f.r.random() < 0.3:
            s = [*s, (f.one(" ", "\n", ". "), None), *([(f.one(*around), None)] if f.r.random() < 0.4 else f.fill(f.one(*NONE)))]
        if f.r.random() < 0.08:  # blanks doubled throughout
            wide = " " * f.r.randint(2, 3)
            s = [(wide.join(p.split(" ")), k) for p, k in s]
        out.append(s)
    out += [[(s, None)] for s in plain]
    out += [[(s.upper(), None)] for s in plain]
    out += [[(" ".join(w.capitalize() for w in s.split()), None)] for s in around]
    return out, f.invented
