"""Made sentences to start problem 10 from: severe, other-sense and ordinary ones in four languages.

They are built from templates with slots. They name no real people: groups are invented or
general. A reader of this file meets abusive language, since a filter must have seen it.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

#: Nouns that insult whoever they are said of, without accents.
INSULTS = set(
    "asshole arsehole assholes bitch bitches bastard cretin cunt dickhead dipshit dirtbag douchebag dumbass dumbfuck fuckwit fucker fuckface halfwit jackass jerk "
    "moron motherfucker nitwit pieceofshit prick scumbag shithead shit slut sonofabitch twat wanker whore imbecile imbecil imbeciles scum loser lowlife "
    "connard connasse enfoire abruti salaud salope encule batard ordure pourriture debile cretine crevard petasse putain fumier "
    "arschloch wichser drecksack missgeburt schwachkopf hurensohn dreckskerl vollidiot miststuck schlampe fotze arsch trottel depp scheisskerl mistkerl spast vollpfosten dummkopf "
    "gilipollas cabron cabrona hijodeputa hijoputa puta maricon pendejo capullo mamon subnormal zorra malparido gilipolla cretino idiota estupido".split()
)
#: Words that insult only when aimed at someone.
MILD = set("penner retard clown idiot idiots idiote parasite pig pigs swine fool dumb stupid miserable worthless pathetic moronic ass coward schwein sau affe ratte esel dumme dummer blode bloder erbarmliche erbarmlicher payaso cerdo burro inutil asqueroso asquerosa maldito maldita basura porc cochon ane clochard minable pauvre crapule raclure parasit parasito parasita idioten".split())
#: Explicit words of sex, and words that may be.
EXPLICIT = set(
    "blowjob blowjobs handjob porn porno pornos porns pornographie pornografia xxx tits titties pussies pussy cocks cum cumshot dildo horny milf gangbang orgasm camgirl sexcam sexcams uncensored "
    "baiser baise bite chatte nichons fellation bander ficken fickt gefickt titten muschi schwanz wichsen geile geil geilen nacktbilder nacktfotos bumsen vogeln "
    "follar follando follada follo polla tetas mamada corrida cachonda cachondas".split()
)
SUGGESTIVE = set("sex sexual naked nude nudes nudity breast breasts cock ass moaned moaning moan panties escort webcam nackt nackte nackten stohnte stohnen nue nues nus gemissait seins desnuda desnudas desnudo desnudos gemia pechos sexo sexe hoschen strip stripped".split())
#: Words that call a group less than human.
DEHUMANISING = set(
    "subhuman subhumans vermin filthy plague inferior thieves parasites savages cockroaches exterminated vermine voleurs inferieure inferieurs soushommes nuisibles cafards "
    "ungeziefer minderwertig minderwertige dreckige diebe untermenschen abschaum parasiten schmarotzer plaga ladrones escoria alimañas alimanas subhumanos parasitos cucarachas".split()
)
LEXICON = INSULTS | MILD | EXPLICIT | SUGGESTIVE | DEHUMANISING
LISTS = {"abuse": (INSULTS, MILD), "hate": (DEHUMANISING, set()), "sexual": (EXPLICIT, SUGGESTIVE)}

SLOTS = {
    "en": {
        "adj": "stupid|ugly|disgusting|repulsive|pathetic|dumb|worthless|useless|fat|filthy|lying|miserable|brainless|rotten|vile|hideous|lazy|ignorant|slimy|spineless",
        "insult": "creature|rat|pig|worm|piece of trash|garbage|waste of space|dog|snake|toad|leech|idiot|fool|clown|coward|moron|asshole|bastard|scumbag|bitch|loser|prick|jerk|dickhead|dumbass|halfwit|imbecile|cretin|parasite|twat|dipshit|dirtbag",
        "harm": "kill|stab|shoot|strangle|beat|hurt|punch|smash|hunt down|cut|drown|crush|bury|gut", "part": "teeth|arms|neck|fingers|skull|ribs|nose|face",
        "suffer": "die|rot|burn|drown|suffer|bleed|crash|starve|get cancer", "fword": "fucking|damn|bloody|goddamn",
        "group": "foreigners|immigrants|refugees|migrants|minorities|Xians|Tarvans|Oleks|Brunnites|Zelari|hill folk|islanders|outsiders|northerners|Vasks|Gorlanders|Ettari",
        "low": "vermin|subhuman|filth|parasites|scum|savages|animals|criminals|thieves|rats|cockroaches|a plague|a disease|mongrels|trash|leeches|dirt|liars|an infection|a cancer|inferior|a lower race",
        "gone": "deported|wiped out|exterminated|expelled|thrown out|locked up|shot|banned|hunted|sterilised|driven into the sea|removed from our land|eliminated",
        "right": "marry|vote|work here|own houses|go to school|hold office|speak in public|have children",
        "place": "houses|shops|churches|mosques|villages|homes|schools",
        "her": "she|the girl|my wife|the secretary|his girlfriend", "xadj": "horny|naked|wet|nude|sexy|dirty|hot|busty|kinky", "xnoun": "girls|women|milfs|babes|wives|couples|sluts|models",
        "organ": "cock|dick|pussy|tits|ass|clit|nipples|breasts", "xdo": "fuck|suck|lick|ride|strip|masturbate|cum|touch themselves|play with themselves|have an orgasm|spank", "xdid": "fucked|sucked|licked|rode|banged|stripped|fingered|humped|undressed|spanked", "sell": "porn|erotic films|adult movies|sex videos|xxx clips|sex cams|porn movies|hardcore videos|nudes|sex chat",
    },
    "fr": {
        "adj": "stupide|moche|dégoûtant|minable|inutile|sale|gros|répugnant|lâche|pitoyable|ignoble|débile", "insult": "rat|porc|ordure|connard|enfoiré|salaud|abruti|crétin|imbécile|idiot|clown|pourriture|déchet|salope|batard|parasite|lâche|chien|débile|clochard",
        "harm": "tuer|frapper|étrangler|égorger|cogner|massacrer|écraser|noyer", "part": "dents|bras|doigts|nez|cou|gueule", "suffer": "mourir|crever|brûler|souffrir|pourrir|te noyer",
        "group": "étrangers|immigrés|réfugiés|migrants|Xians|Tarvans|Oleks|Brunnites|Zelari|montagnards|Vasks|Ettari", "low": "vermine|sous-hommes|parasites|voleurs|animaux|rats|cafards|menteurs|une peste|une maladie|une sale race|des criminels|inférieurs",
        "gone": "expulsés|éliminés|exterminés|enfermés|chassés|fusillés|interdits|bannis|renvoyés", "right": "voter|travailler ici|se marier|posséder des terres|parler", "place": "maisons|temples|églises|villages|écoles|boutiques",
        "xadj": "nues|chaudes|coquines|sexy|salopes|excitées", "xnoun": "femmes|filles|nanas|étudiantes|secrétaires", "organ": "bite|chatte|seins|cul|nichons", "xdo": "baiser|sucer|lécher|jouir|se déshabiller|se masturber|se caresser", "sell": "porno|vidéos de sexe|photos de cul|sexcam|films x|photos nues",
    },
    "de": {
        "adj": "dummer|hässlicher|ekelhafter|erbärmlicher|nutzloser|dreckiger|fetter|widerlicher|feiger|blöder|mieser|elender", "insult": "Idiot|Arschloch|Wichser|Drecksack|Schwachkopf|Hurensohn|Trottel|Abschaum|Ratte|Schwein|Wurm|Versager|Vollidiot|Mistkerl|Clown|Depp|Missgeburt|Parasit|Feigling|Penner",
        "harm": "töten|schlagen|erwürgen|abstechen|verprügeln|erschießen|ertränken|zerquetschen", "part": "Zähne|Arme|Finger|Nase|Rippen|Knochen", "suffer": "sterben|verrecken|verbrennen|leiden|ersaufen|verfaulen",
        "group": "Ausländer|Einwanderer|Flüchtlinge|Migranten|Xianer|Tarvaner|Oleks|Brunniten|Zelari|Bergleute|Vasken|Ettari", "low": "Ungeziefer|Untermenschen|Parasiten|Diebe|Tiere|Ratten|Kakerlaken|Abschaum|Lügner|eine Seuche|eine Krankheit|minderwertig|Verbrecher|Dreck",
        "gone": "abgeschoben|ausgerottet|vertrieben|eingesperrt|verjagt|erschossen|verboten|rausgeworfen|vernichtet", "right": "wählen|hier arbeiten|heiraten|Land besitzen|reden", "place": "Häuser|Tempel|Kirchen|Dörfer|Schulen|Läden",
        "xadj": "nackte|geile|heiße|nasse|versaute|willige", "xnoun": "Frauen|Mädels|Studentinnen|Hausfrauen|Weiber", "organ": "Schwanz|Muschi|Titten|Arsch|Brüste", "xdo": "ficken|blasen|lecken|bumsen|wichsen|strippen|masturbieren|ausziehen", "sell": "Pornos|Sexvideos|Nacktbilder|Sexcam|Sexfilme|Nacktfotos",
    },
    "es": {
        "adj": "estúpido|feo|asqueroso|inútil|sucio|gordo|repugnante|cobarde|patético|miserable|maldito|podrido", "insult": "idiota|imbécil|cabrón|gilipollas|payaso|cerdo|rata|basura|pendejo|hijo de puta|perra|capullo|cretino|parásito|gusano|burro|desgraciado|zorra|estúpido",
        "harm": "matar|golpear|estrangular|apuñalar|pegar|aplastar|ahogar|degollar", "part": "dientes|brazos|dedos|nariz|huesos|cuello", "suffer": "morir|pudrirte|arder|sufrir|ahogarte|reventar",
        "group": "extranjeros|inmigrantes|refugiados|migrantes|xianos|tarvanos|oleks|brunitas|zelaris|montañeses|vascones|etaris", "low": "ratas|subhumanos|parásitos|ladrones|animales|cucarachas|escoria|mentirosos|una plaga|una enfermedad|inferiores|criminales|alimañas|basura",
        "gone": "expulsados|eliminados|exterminados|encerrados|fusilados|prohibidos|deportados|echados", "right": "votar|trabajar aquí|casarse|tener tierras|hablar", "place": "casas|templos|iglesias|aldeas|escuelas|tiendas",
        "xadj": "desnudas|cachondas|calientes|mojadas|sexys|guarras", "xnoun": "mujeres|chicas|maduras|estudiantes|vecinas", "organ": "polla|coño|tetas|culo|pechos", "xdo": "follar|chupar|lamer|correrse|desnudarse|masturbarse|tocarse", "sell": "porno|vídeos de sexo|fotos guarras|sexcam|películas x|fotos desnudas",
    },
}
SEVERE = {
    "abuse": {
        "en": "you {adj} {insult}|you are a {adj} {insult}|you're such a {insult}|what a {adj} {insult} you are|you {fword} {insult}|get out {insult}|you {insult} , leave us alone|that is what a {insult} like you says|a {insult} like you makes me sick|he is a {fword} {insult}|she is a {fword} {insult} and so are you|you are all {insult}s|hey {insult} , shut up|shut your {fword} mouth|fuck you {insult}|fuck you|fuck off|screw you , you {adj} {insult}|go to hell you {insult}|are you a {insult} or what|is he a {fword} {insult}"
        "|I will {harm} you|I'm going to {harm} you tonight|someone should {harm} you|we will find you and {harm} you|I'll break your {part}|he wants to smash your {part}|I swear I will {harm} you and your family|watch your back , I am coming to {harm} you|I have your address and I am coming with a knife|you will pay for this , I'll break both your legs|get lost you {insult}|piss off {insult}|come here and I will {harm} you|I hope you {suffer}|you should {suffer}|just {suffer} already|you deserve to {suffer}|why don't you go and {suffer}|kill yourself|the world is better when you {suffer}|no one cares if you {suffer}|everyone hates you|you are worthless|you disgust me|nobody needs you|nobody loves you {insult}|your mother is a {insult}|nobody will cry when you are dead|go back to your hole you {insult}",
        "fr": "espèce de {insult}|sale {insult}|tu es un {insult}|t'es vraiment un {adj} {insult}|quel {insult} celui-là , tu me dégoûtes|pauvre {insult}|ferme-la {insult}|va te faire foutre|dégage {insult}|je vais te {harm}|on va te {harm} ce soir|je vais te casser le {part}|j'espère que tu vas {suffer}|tu devrais {suffer}|tu mérites de {suffer}|personne ne t'aime {insult}|toi tu n'es qu'un {insult}|j'ai ton adresse et je viens te {harm}|casse-toi d'ici {insult}|nique ta mère|ta mère est une {insult}|tais-toi {adj} {insult}|je te retrouverai pour te {harm}|gros {insult}|tu n'es qu'une merde",
        "de": "du {insult}|du {adj} {insult}|du bist ein {insult}|du bist so ein {adj} {insult}|was für ein {insult} du bist|halt dein Maul {insult}|halt die Klappe du {insult}|verpiss dich|hau ab du {insult}|fick dich|ich werde dich {harm}|wir finden dich und {harm} dich|ich breche dir die {part}|ich hoffe du wirst {suffer}|du sollst {suffer}|du verdienst es zu {suffer}|keiner mag dich {insult}|niemand braucht dich|ihr seid alle {insult}|deine Mutter ist eine Hure|geh {suffer}|ich kenne deine Adresse und komme mit dem Messer|dann gibt es was auf die Fresse|ich breche dir beide Beine|verschwinde du {insult}|leck mich du {insult}|so ein {insult} wie du|ich komme und hole dich dann setzt es Schläge",
        "es": "eres un {insult}|maldito {insult}|pedazo de {insult}|qué {insult} eres|eres un {adj} {insult}|cállate {insult}|cierra el pico {insult}|vete al infierno {insult}|vete a la mierda|que te den {insult}|te voy a {harm}|voy a {harm} te esta noche|te romperé los {part}|ojalá te mueras|espero que te toque {suffer}|deberías {suffer}|mereces {suffer}|nadie te quiere {insult}|fuera de aquí {insult}|lárgate {insult}|tu madre es una {insult}|jódete {insult}|das asco {insult}|tengo tu dirección y voy con un cuchillo|te voy a partir la cara|te parto las piernas|piérdete {insult}|iremos a por ti y te vamos a {harm}",
    },
    "hate": {
        "en": "{group} are {low}|all {group} are {low}|the {group} are nothing but {low}|these {group} are {low} and must go|those {group} are dirty {low}|{group} should be {gone}|all {group} must be {gone}|the {group} have to be {gone}|I want every {group} {gone}|kick the {group} out|throw all {group} out of our country|send the {group} home|we must get rid of all {group}|get rid of the {group}|{group} do not belong here|{group} don't deserve rights|{group} must not {right}|never let {group} {right}|no {group} should be allowed to {right}|do not trust any {group} , they are {low}|never believe a {group}|the country is better without {group}|how nice if all {group} vanished|I wish every {group} family were gone|burn the {group} {place}|set fire to their {place}|{group} breed like rats|{group} are a lesser race|{group} blood is dirty|hang the {group}|death to the {group}|{group} are ruining our land like {low}|a good {group} is a dead {group}|they are {low} , those {group}",
        "fr": "les {group} sont {low}|les {group} sont des {low}|tous les {group} sont des {low}|les {group} doivent être {gone}|il faut chasser tous les {group}|dehors les {group}|mort aux {group}|les {group} ne méritent pas de {right}|interdisez aux {group} de {right}|brûlons les {place} des {group}|ne faites jamais confiance aux {group}|le pays serait mieux sans les {group}|débarrassons-nous des {group}|les {group} n'ont rien à faire ici|je veux voir les {group} {gone}|ces {group} , une race de {low}|vivement que les {group} disparaissent tous",
        "de": "{group} sind {low}|die {group} sind {low}|alle {group} sind {low}|die {group} müssen {gone} werden|alle {group} gehören {gone}|raus mit den {group}|{group} raus|weg mit allen {group}|tod den {group}|{group} dürfen nie {right}|kein {group} soll {right}|brennt die {place} der {group} nieder|traut keinem {group}|ohne {group} wäre das Land besser|werft die {group} aus unserem Land|ich will alle {group} {gone} sehen|diese {group} sind eine Rasse von {low}|hoffentlich verschwinden alle {group}|schickt die {group} zurück",
        "es": "los {group} son {low}|los {group} son unos {low}|todos los {group} son {low}|los {group} deben ser {gone}|hay que echar a los {group}|fuera los {group}|muerte a los {group}|los {group} no merecen {right}|que los {group} no puedan {right}|quememos las {place} de los {group}|no os fiéis de los {group}|el país estaría mejor sin {group}|hay que librarse de los {group}|hay que terminar con los {group}|que se acaben los {group}|no queremos más {group} aquí|los {group} sobran aquí|quiero ver a los {group} {gone}|esos {group} son una raza de {low}|ojalá desaparezcan todos los {group}",
    },
    "sexual": {
        "en": "{her} wants to {xdo} him|{her} {xdid} his {organ}|he {xdid} her {organ}|he put his {organ} in her|{her} begged for his {organ}|{her} took off her panties and {xdid} him|they had sex all night on the bed|they were naked and {xdid} each other|{her} moaned as he {xdid} her|he came inside her with a groan|{her} had an orgasm|he undressed her and kissed her {organ}|{her} unbuttoned his pants and {xdid} him|he pushed his {organ} deep into her|her thighs were wet with lust|{xadj} couples have sex on camera|{her} touched herself in front of the camera|{her} gave him a blowjob|he grabbed her {organ}|watch {xadj} {xnoun} {xdo}|{xadj} {xnoun} want to {xdo} you now|free {sell} of {xadj} {xnoun}|{sell} for adults only|watch free {sell}|chat with {xadj} {xnoun} on cam|see {xnoun} {xdo} live on webcam|download {sell} now|{xadj} {xnoun} naked pictures|her wet {organ} and his hard {organ}|come and see my {organ}|{xadj} and {xadj} {xnoun} {xdo} for you|{organ} and {organ} uncut , no charge|uncensored {sell}",
        "fr": "elle voulait {xdo} avec lui|il lui a pris les {organ}|elle lui suce la {organ}|{xnoun} {xadj} en webcam|des {xnoun} {xadj} veulent {xdo} ce soir|{sell} gratuit|{sell} pour adultes|regarde des {xnoun} {xadj}|ils ont baisé toute la nuit|elle a enlevé sa culotte et il l'a baisée|elle gémit pendant qu'il la baise|sa {organ} mouillée|viens {xdo} avec moi|{xnoun} qui veulent {xdo} en direct|elle se caresse et jouit devant la webcam|il embrasse ses {organ}|il entre en elle et jouit|{xnoun} {xadj} en vidéo porno",
        "de": "sie wollte ihn {xdo}|er packte ihre {organ}|sie will seinen {organ}|{xadj} {xnoun} vor der Webcam|{xadj} {xnoun} wollen {xdo}|{sell} gratis|{sell} für Erwachsene|gratis {sell} mit {xadj} {xnoun}|sie fickten die ganze Nacht|er zog ihr den Slip aus und fickte sie|sie stöhnte als er sie fickte|ihre feuchte {organ}|komm und lass uns {xdo}|schau {xnoun} live beim {xdo} zu|sie befriedigt sich vor der Webcam|er küsste ihre {organ}|er kam in ihr|versaute Paare beim {xdo}|er schob seinen {organ} in sie",
        "es": "ella quería {xdo} con él|él le agarró las {organ}|ella le chupa la {organ}|{xnoun} {xadj} en webcam|{xnoun} {xadj} quieren {xdo} esta noche|{sell} gratis|{sell} para adultos|mira {xnoun} {xadj} en directo|follaron toda la noche|le quitó las bragas y se la folló|ella gime mientras él la folla|su {organ} mojada|ven a {xdo} conmigo|{xnoun} que quieren {xdo} en vivo|ella se toca y gime delante de la webcam|él le besó las {organ}|él se corrió dentro de ella|parejas guarras en películas porno",
    },
}
#: Sensitive words in another sense, and neighbours of the severe ones that are harmless.
OTHER = {
    "en": "the word {insult} comes from an old Latin term|what does {insult} mean in this dictionary|the term {insult} was once used in law|I felt like a {insult} that day|I am such a {insult} , I told myself|I called myself a {insult}|he plays the {insult} in the circus|a {insult} chisel hangs in the workshop|the bitch nursed her litter in the kennel|a rat or a pig learns fast|a toad lives in the pond|the snake and the worm live in the soil|a donkey or ass stood in the stable|the program was killed by the scheduler|shoot the scene again|beat the eggs with sugar|cut the bread|bury the cable|crush the grapes|drown the rice in water|I will call you tonight|I'm going to help you|I will find you a seat|I hope you enjoy the trip|I hope you get well|you should see the view|you deserve to win|you are a kind friend|you are such a good teacher|what a clever child you are|he is a fast runner and so are you|nobody told you about the road|everyone loves you|if you drop the glass it breaks|you lost the key|break the ice|your mother is a doctor|listen to the band|get out at the next stop"
    "|she rejects the idea that {group} are {low}|no one should call {group} {low}|he denied that {group} are {low}|she condemned the claim that {group} are {low}|calling {group} {low} is a shame|prejudice says that {group} are {low} , and it is false|how mean to say {group} are {low}|it was never true that {group} are {low}|you should not say that {group} are {low}|it is mean to claim the {group} should be {gone}|whoever says that the {group} must go is unfair|it hurts to hear people say that {group} do not belong here|it is unkind to say that the {group} do not belong here|how unfair to say that {group} do not belong here|she thinks it is bad to say that the {group} do not belong|no decent person would say the {group} should be {gone}|we must defend {group} against hate|the {group} are farmers and fishermen|{group} live near the river|the {group} sing at the feast|most {group} {right} today|the {group} are famous for music and bread|{group} were {gone} in the war , the historian writes|rats and cockroaches are vermin in the kitchen|the parasites live in the liver of the sheep|insects are a plague for the crops|the disease spread among the cattle|the thieves were arrested by police|the wine is of inferior quality|the court banned the sale|send the letter home|throw the old shoes out|get rid of the rust|wolves and other animals were hunted here|never trust the weather"
    "|the doctor examined the breast tissue|a lump in the breast needs a scan|the nurse explains sexual health|lessons on sex and consent at school|sexual reproduction in ferns|the sex of the chick is hard to tell|the cock and the hen are in the yard|great tits nest in the box|chicken breast with rice|the nude figure in the painting|a naked statue in the museum|the artist paints nudes|a hot soup and hard bread|the hotel room was hot|dirty dishes and wet towels|adults pay more at the pool|watch the game live|free maps for children|he sucked a lemon|she rode the horse all night|they were in bed with a cold|strip the paint from the door|cam shaft of the engine",
    "fr": "le mot {insult} vient du latin|je me sentais comme un {insult}|je me suis traité de {insult}|un rat ou un porc apprend vite|l'âne est à l'étable|le clown fait rire les enfants au cirque|le programme a été tué par le système|frapper à la porte|je vais te montrer le jardin|j'espère que tu vas réussir|tu es un bon ami|tu devrais visiter le musée|la chienne allaite ses petits|il est en retard|pauvre homme dit le médecin|elle refuse l'idée que les {group} sont des {low}|il n'est pas vrai que les {group} sont {low}|quelle honte de dire que les {group} sont {low}|il est injuste de dire que les {group} doivent être {gone}|ça fait mal d'entendre dire que les {group} n'ont rien à faire ici|on ne doit pas traiter les {group} de {low}|les {group} sont des paysans|les {group} habitent près du fleuve|les {group} sont célèbres pour leur musique|les rats sont des nuisibles dans la cuisine|une maladie du foie chez le mouton|les voleurs ont été arrêtés|vin de qualité inférieure|les {group} furent {gone} pendant la guerre , dit l'historien|une grosseur au sein demande un examen|le sexe du poussin est difficile à voir|un nu du peintre au musée|la poule et le coq|cours d'éducation sexuelle à l'école|la chatte a eu des petits|soupe chaude et pain dur|le spectacle en direct|entrée gratuite pour les enfants",
    "de": "das Wort {insult} stammt aus dem Lateinischen|ich war so ein {insult} an dem Tag|ich nannte mich selbst einen {insult}|eine Ratte oder ein Schwein lernt schnell|der Esel steht im Stall|der Clown im Zirkus|das Programm wurde vom System beendet|ich werde dich anrufen|ich hoffe du wirst gesund|du bist ein guter Freund|du sollst das Museum besuchen|die Hündin säugt ihre Jungen|Eier schaumig schlagen|es stimmt nicht dass {group} {low} sind|es ist eine Schande {group} {low} zu nennen|sie verwarf die Behauptung {group} seien {low}|es ist ungerecht zu sagen die {group} müssen {gone} werden|es tut weh zu hören dass die {group} nicht hierher gehören|niemand soll sagen die {group} sind {low}|die {group} sind Bauern und Fischer|{group} leben am Fluss|die {group} sind berühmt für ihre Musik|Ratten sind Ungeziefer in der Küche|eine Krankheit der Leber beim Schaf|die Diebe wurden verhaftet|Ware von minderwertiger Qualität|die {group} wurden im Krieg {gone} , schreibt der Historiker|ein Knoten in der Brust muss untersucht werden|das Geschlecht des Kükens ist schwer zu sehen|ein Akt des Malers im Museum|der Hahn und die Henne|Sexualkunde in der Schule|der Schwanz des Hundes|geile Triebe der Pflanze abschneiden|nackte Wände im Haus|heiße Suppe|Konzert live|gratis Eintritt für Kinder",
    "es": "la palabra {insult} viene del latín|me sentí como un {insult}|me llamé {insult} a mí mismo|una rata o un cerdo aprende rápido|el burro está en el establo|el payaso del circo hace reír|el sistema mató el programa|golpear la puerta|te voy a llamar mañana|te voy a enseñar el jardín|espero que te mejores|eres un buen amigo|deberías visitar el museo|la perra amamanta a su camada|no es verdad que los {group} sean {low}|es una vergüenza llamar {low} a los {group}|ella rechazó la idea de que los {group} son {low}|es injusto decir que los {group} deben ser {gone}|duele oír que los {group} sobran aquí|nadie debe decir que los {group} son {low}|los {group} son pescadores|los {group} viven junto al río|los {group} son famosos por su música|las ratas son una plaga en la cocina|una enfermedad del hígado en las ovejas|los ladrones fueron detenidos|vino de calidad inferior|los {group} fueron {gone} en la guerra , dice el historiador|un bulto en el pecho necesita un examen|el sexo del pollito es difícil de ver|un desnudo del pintor en el museo|el gallo y la gallina|educación sexual en la escuela|pechuga con arroz|sopa caliente|partido en directo|entrada gratis para niños",
}
ORDINARY = {
    "en": "the {a} {v} the {n} {t}|a {n} near the {n} {v} {t}|nobody knows why the {n} {v} it|in {y} the {n} was {a}|have you ever seen a {a} {n}|our {n} and their {n} {v} {t}|I think the {n} is {a}|you can see the {n} from here|all the people of the town {v} the {n}|they are in the {n} now|everyone came to look at the {n}|when they {v} the {n} it was {a}|some say the {n} was {a}|the story of the {n} is simple|let us talk about the {n} today",
    "fr": "le {n} {v} la {n} {t}|personne ne sait pourquoi le {n} {v}|en {y} la {n} était {a}|tu vois le {n} d'ici|les gens du village {v} le {n}|je pense que la {n} est {a}|voici l'histoire du {n}|ils sont dans la {n}",
    "de": "der {n} {v} die {n} {t}|niemand weiß warum der {n} {v}|im Jahr {y} war die {n} {a}|du siehst den {n} von hier|die Leute im Dorf {v} den {n}|ich denke der {n} ist {a}|hier ist die Geschichte vom {n}|sie sind im {n}",
    "es": "el {n} {v} la {n} {t}|nadie sabe por qué el {n} {v}|en {y} la {n} era {a}|ves el {n} desde aquí|la gente del pueblo {v} el {n}|creo que la {n} es {a}|esta es la historia del {n}|están en la {n}",
}
#: Harmless sentences in the frames of the severe ones.
KIND = {
    "en": "I will {help} you|I'm going to {help} you tonight|I'll {help} you in the morning|someone should {help} you|somebody should {chore} the {n}|you {good} {person}|you are a {good} {person}|what a {good} {person} you are|you're such a {good} {person}|I hope you {well}|you deserve to {well}|you should {well}|everyone likes you|the {group} are {job}|all {group} are {job}|{group} {live}|we have to {chore} every {n}|{her} {calm}|{her} {calm} and he {calm}|download free {file}|watch the {file} of the {n}|he is a {good} {person}|get every {n} out of the shed|never let a {person} {calm} alone|my {person} is {good}",
    "fr": "je vais t'{help}|tu es un {good} {person}|quel {good} {person}|j'espère que tu vas {well}|tu mérites de {well}|tu devrais {well}|les {group} sont des {job}|les {group} {live}|elle {calm}|il {calm} le soir|on va {chore} la {n}|le pays est plus calme cette année|regarde le {file} du {n}|toi mon {person}",
    "de": "ich werde dir {help}|ich werde dich morgen {help}|du bist ein {good} {person}|du bist so ein {good} {person}|was für ein {good} {person} du bist|ich hoffe du wirst {well}|du verdienst es zu {well}|du sollst {well}|die {group} sind {job}|{group} {live}|sie {calm}|er {calm} am Abend|wir müssen das {n} {chore}|schau das {file} vom {n}",
    "es": "te voy a {help}|voy a {help} contigo esta noche|eres un {good} {person}|qué {good} {person} eres|espero que puedas {well}|mereces {well}|deberías {well}|los {group} son {job}|los {group} {live}|ella {calm}|él {calm} por la tarde|hay que {chore} la {n}|mira el {file} del {n}",
}
COMMON = {
    "en": {"help": "help|visit|thank|feed|drive home|teach|phone|meet|remember|pay|write to|see", "good": "kind|gentle|funny|brave|smart|quiet|fine|generous|careful|cheerful", "person": "friend|neighbour|driver|child|singer|nurse|cook|student|doctor|player|fellow", "chore": "clean|mend|sell|water|count|carry|close", "well": "sleep well|win|rest|learn fast|recover|travel|laugh|eat something", "job": "fishermen|farmers|sailors|weavers|miners|traders|good hosts|shepherds|friendly people", "live": "live by the lake|trade with the coast|keep goats|dance at weddings|build good boats", "calm": "sang a song|read the paper|closed the door|made some tea|took off the coat|opened the bag|slept well|cut the rope|washed the cup", "file": "maps|songs|recipes|pictures|lessons|film", "a": "old|big|new|quiet|strange|early|wooden|small", "n": "bridge|garden|tower|teacher|boat|market|clock|road|school|letter|engine|house", "v": "built|found|painted|sold|watched|moved|opened|lost", "t": "last year|in the morning|before the rain|with great care|again", "y": "1902|1954|1987|2013"},
    "fr": {"help": "aider|écrire|inviter|attendre|expliquer cela|accompagner", "good": "bon|gentil|brave|drôle|fidèle|grand", "person": "voisin|cuisinier|ami|chanteur|élève|médecin", "chore": "nettoyer|réparer|vendre|fermer|peindre", "well": "dormir|gagner|réussir|te reposer|guérir", "job": "paysans|marins|bergers|tisserands|marchands", "live": "vivent près du lac|dansent aux mariages|élèvent des chèvres", "calm": "chante une chanson|lit le journal|ferme la porte|parle à la radio|ouvre son manteau|lave la tasse", "file": "film|plan|dessin", "a": "vieille|grande|calme|belle|étrange", "n": "pont|maison|tour|marché|bateau|école|route|lettre", "v": "construit|trouve|regarde|vend|ouvre", "t": "au matin|avant la pluie|encore|hier", "y": "1902|1954|1987"},
    "de": {"help": "helfen|schreiben|danken|zuhören|abholen|einladen", "good": "guter|netter|lustiger|mutiger|kluger|ruhiger", "person": "Freund|Nachbar|Fahrer|Sänger|Arzt|Lehrer|Bäcker", "chore": "putzen|reparieren|verkaufen|schließen|streichen", "well": "schlafen|gewinnen|lachen|lernen|ausruhen", "job": "Bauern|Fischer|Hirten|Händler|Weber", "live": "leben am See|tanzen auf Hochzeiten|halten Ziegen", "calm": "singt ein Lied|liest die Zeitung|schließt die Tür|spricht im Radio|öffnet den Mantel|wäscht die Tasse", "file": "Bild|Lied|Spiel", "a": "alt|groß|still|neu|seltsam", "n": "Brücke|Haus|Turm|Markt|Boot|Schule|Straße|Brief", "v": "baut|findet|sieht|verkauft|öffnet", "t": "am Morgen|vor dem Regen|wieder|gestern", "y": "1902|1954|1987"},
    "es": {"help": "ayudar|escribir|invitar|esperar|explicar algo|acompañar", "good": "buen|gran|fiel|simpático|amable", "person": "amigo|médico|cantante|alumno|cocinero", "chore": "limpiar|reparar|vender|cerrar|pintar", "well": "dormir|ganar|descansar|reír|aprender", "job": "pastores|marineros|campesinos|tejedores|buenos vecinos", "live": "viven junto al lago|bailan en las bodas|crían cabras", "calm": "canta una canción|lee el periódico|cierra la puerta|habla en la radio|abre el abrigo|lava la taza", "file": "mapa|dibujo|partido", "a": "vieja|grande|tranquila|nueva|extraña", "n": "puente|casa|torre|mercado|barco|escuela|calle|carta", "v": "construye|encuentra|mira|vende|abre", "t": "por la mañana|antes de la lluvia|otra vez|ayer", "y": "1902|1954|1987"},
}
_SLOT = re.compile(r"\{(\w+)\}")


def _fill(template: str, slots: dict[str, list[str]], rng: random.Random) -> str:
    return _SLOT.sub(lambda m: rng.choice(slots[m[1]]), template)


def sentences(without: frozenset[str] = frozenset(), seed: int = 11) -> Iterator[tuple[str | None, int, str]]:
    """(category or None, grade, sentence): 2 severe, 1 sensitive words in another sense, 0 ordinary.

    *without* are slot fillers to leave out, to hold words back for a test.
    """
    rng = random.Random(seed)
    for language, raw in SLOTS.items():
        slots = {k: [w for w in v.split("|") if w not in without] for k, v in (raw | COMMON[language]).items()}
        for category, by_language in SEVERE.items():
            for template in by_language[language].split("|"):
                for _ in range(min(11, 1 + 5 * len(_SLOT.findall(template)))):
                    yield category, 2, _fill(template, slots, rng)
        for template in OTHER[language].split("|"):
            for _ in range(min(11, 1 + 5 * len(_SLOT.findall(template)))):
                yield None, 1, _fill(template, slots, rng)
        for template in (*ORDINARY[language].split("|"), *KIND[language].split("|")):
            for _ in range(12):
                yield None, 0, _fill(template, slots, rng)
