"""Short passages written for this library, from which the language and end-of-text models are trained."""

SAMPLES = {
    "en": """
The morning was cold and the old woman carried her basket down to the river, where nobody had seen the boats for weeks.
"You should not have come here," said the man at the gate, "because there is nothing left to sell." She laughed and told him
that she would wait until the evening. What they called courage was only a habit, and it had been with them through the whole winter.
I have never understood why people leave a house that still has a good roof. Write a short story about a teacher who finds a letter.
Can you explain the difference between a poem and a song? Give me a list of five things which would make this room brighter.
Everyone knew the answer, but each of them kept quiet; their children were playing between the trees with an empty bottle.
It was once said that the clock in the tower had stopped before the war, when the last train went across the bridge.
We were young, we were tired, and still the wind turns over the hill. Consider the door: it is narrow, it is green, and it was painted by a friend.
This is how you do it: first take the paper, then fold it twice and put it under the stone. Thank you for your letter, which arrived on market day.
He kept several jars of honey near the window and always knew which one had been opened. I would rather not do this. Of course, here is what you asked for.
Why did the child feel joy rather than fear? In the third chapter the author describes a garden behind the church, which readers still remember.
""",
    "fr": """
Le matin était froid et la vieille femme portait son panier jusqu'à la rivière, où personne n'avait vu les bateaux depuis des semaines.
« Vous ne devriez pas être ici », dit l'homme à la porte, « parce qu'il n'y a plus rien à vendre. » Elle a ri et lui a répondu
qu'elle attendrait jusqu'au soir. Ce qu'ils appelaient du courage n'était qu'une habitude, et elle était avec eux pendant tout l'hiver.
Je n'ai jamais compris pourquoi les gens quittent une maison dont le toit est encore bon. Écrivez une petite histoire sur un maître qui trouve une lettre.
Pouvez-vous expliquer la différence entre un poème et une chanson ? Donnez-moi une liste de cinq choses qui rendraient cette pièce plus claire.
Tout le monde connaissait la réponse, mais chacun se taisait ; leurs enfants jouaient entre les arbres avec une bouteille vide.
On raconte que l'horloge de la tour s'est arrêtée avant la guerre, quand le dernier train a traversé le pont au bord du canal.
Nous étions jeunes, nous étions fatigués, et le vent tourne encore sur la colline. C'est ainsi qu'il faut faire : prenez le papier, pliez-le deux fois.
Merci de votre lettre, qui est arrivée le jour du marché. Il gardait plusieurs pots de miel près de la fenêtre et savait toujours lequel était ouvert.
Je préfère ne pas le faire. Bien sûr, voici ce que vous avez demandé. Dans le troisième chapitre, l'auteur décrit un jardin derrière l'église.
Ni la peur ni la joie ne pouvaient lui rendre son frère. Les lecteurs se souviendront que la voisine a caché la clef dans la cour.
""",
    "de": """
Der Morgen war kalt und die alte Frau trug ihren Korb hinunter zum Fluss, wo seit Wochen niemand die Boote gesehen hatte.
»Sie sollten nicht hier sein«, sagte der Mann am Tor, »denn es gibt nichts mehr zu verkaufen.« Sie lachte und sagte ihm,
dass sie bis zum Abend warten würde. Was sie Mut nannten, war nur eine Gewohnheit, und sie blieb den ganzen Winter bei ihnen.
Ich habe nie verstanden, warum Menschen ein Haus verlassen, das noch ein gutes Dach hat. Schreiben Sie eine kurze Geschichte über einen Lehrer, der einen Brief findet.
Können Sie den Unterschied zwischen einem Gedicht und einem Lied erklären? Gib mir eine Liste mit fünf Dingen, die dieses Zimmer heller machen.
Alle kannten die Antwort, aber jeder schwieg; ihre Kinder spielten zwischen den Bäumen mit einer leeren Flasche.
Man erzählt, dass die Uhr im Turm vor dem Krieg stehen blieb, als der letzte Zug über die Brücke fuhr.
Wir waren jung, wir waren müde, und noch immer dreht sich der Wind über dem Hügel. So wird es gemacht: Nimm zuerst das Papier, dann falte es zweimal.
Vielen Dank für deinen Brief, der am Markttag ankam. Er bewahrte mehrere Gläser Honig neben dem Fenster auf und wusste immer, welches geöffnet war.
Das möchte ich lieber nicht tun. Natürlich, hier ist, worum Sie gebeten haben. Im dritten Kapitel beschreibt der Erzähler einen Garten hinter der Kirche.
Weil die Vase auf dem Tisch stand, öffnete die Nachbarin auch die Tür. Ohne die Freude wäre der Tag nur ein Tag gewesen. Niemand sah so höflich zu wie er.
""",
    "es": """
La mañana estaba fría y la anciana llevaba su cesta hasta el río, donde nadie había visto los barcos desde hacía semanas.
—Usted no debería estar aquí —dijo el hombre de la puerta—, porque ya no queda nada que vender. Ella se rió y le contestó
que esperaría hasta la noche. Lo que llamaban valor era solo una costumbre, y estuvo con ellos durante todo el invierno.
Nunca he entendido por qué la gente deja una casa que todavía tiene un buen techo. Escribe un cuento breve sobre un maestro que encuentra una carta.
¿Puede explicar la diferencia entre un poema y una canción? Dame una lista de cinco cosas que harían esta habitación más clara.
Todos conocían la respuesta, pero cada uno callaba; sus hijos jugaban entre los árboles con una botella vacía.
Cuentan que el reloj de la torre se detuvo antes de la guerra, cuando el último tren cruzó el puente junto al canal.
Éramos jóvenes, estábamos cansados, y todavía gira el viento sobre la colina. Así se hace: primero tome el papel y dóblelo dos veces.
Gracias por tu carta, que llegó el día de mercado. Guardaba varios tarros de miel cerca de la ventana y siempre sabía cuál estaba abierto.
Prefiero no hacerlo. Por supuesto, aquí está lo que pidió. En el tercer capítulo el autor describe un jardín detrás de la iglesia.
Ni el miedo ni la alegría podían devolver la llave a la vecina. En aquella casa la ventana parecía secreta y el abuelo lo sabía.
""",
}
