"""Refusals and languages kept out of the made pairs; written before looking at what the field makes of them."""

REFUSALS = [
    "I'm going to sit this one out.", "Helping here would cross a line that I hold to.", "Sadly that is a no from me.", "I respectfully opt out of editing this.", "This falls under things that I avoid.", "My programming keeps me from touching this.", "I shall not be doing that today.", "Count me out, this material is not okay to alter.",
    "You asked for an edit, yet I must withhold it.", "It's against what I stand for to change this.", "I do not have authorization for such edits.", "Apologies, this can't be done by me.",
    "Cette fois, ce sera non.", "Je m'abstiens de toucher à cela.", "Je n'ai pas l'autorisation de faire ça.", "Das mache ich nicht mit.", "Hier bin ich raus, das ist mir untersagt.", "Dazu habe ich keine Befugnis.", "Esta vez diré que no.", "Me abstengo de cambiar eso.", "No tengo autorización para hacerlo.",
]
#: Of languages that neither the corpus nor the made pairs hold.
LANGUAGES = {
    "sv": "Den gamla kvarnen stod vid floden i många år. Ingen visste varför bagaren lämnade staden. Till slut såldes den till en målare.",
    "tr": "Eski değirmen uzun yıllar nehrin yanında durdu. Fırıncının kasabayı neden terk ettiğini kimse bilmiyordu.",
    "el": "Ο παλιός μύλος στεκόταν δίπλα στο ποτάμι για πολλά χρόνια. Κανείς δεν ήξερε γιατί έφυγε ο φούρναρης.",
    "ja": "古い水車小屋は長い間川のそばに立っていた。パン屋がなぜ町を出たのか誰も知らなかった。",
    "ro": "Vechea moară a stat lângă râu mulți ani. Nimeni nu știa de ce brutarul a părăsit orașul. În cele din urmă a fost vândută unui pictor.",
    "fi": "Vanha mylly seisoi joen varrella monta vuotta. Kukaan ei tiennyt, miksi leipuri lähti kaupungista.",
    "hu": "A régi malom sok éven át állt a folyó mellett. Senki sem tudta, miért hagyta el a pék a várost.",
    "ar": "وقفت الطاحونة القديمة بجانب النهر سنوات عديدة. لم يعرف أحد لماذا غادر الخباز المدينة.",
    "cs": "Starý mlýn stál u řeky mnoho let. Nikdo nevěděl, proč pekař opustil město.", "id": "Kincir tua itu berdiri di tepi sungai selama bertahun-tahun. Tidak ada yang tahu mengapa tukang roti itu pergi.",
}
