"""Sentences of other templates and other words than the field is trained on, to measure its recall."""

import random

# {kind} marks an entity.
UNSEEN = (
    "If anything is unclear, please drop a line to {email} and we will get back to you.",
    "Questions about the festival should go to {email} by Friday.",
    "Her new work account is {email} since the merger.",
    "Send your CV and two references to {email} today.",
    "Subscribe or unsubscribe through {email} whenever you like.",
    "The editor, reachable under {email}, declined to comment.",
    "You can reach the front desk on {phone} until six.",
    "For bookings dial {phone} and press two.",
    "Our hotline {phone} is open all week.",
    "Text {phone} to confirm your appointment with the dentist.",
    "My sister's number changed to {phone} last month.",
    "Reception: {phone}, ask for Martha.",
    "Packets from {ip} were dropped by the firewall.",
    "The router answers on {ip} only.",
    "We blocked {ip} after several failed attempts.",
    "Ping {ip} twice and restart the printer.",
    "She paid with {card} at the counter.",
    "The account was charged to {card} on Monday.",
    "Please bill my mastercard {card} for both nights.",
    "A receipt showing {card} was found on the floor.",
)
# Written after a first measure, upon which the field was given sentences of filler words alone.
LATER = (
    "Tom typed {card} into the form and pressed enter.",
    "The thief used {card} three times in Lisbon.",
    "Refunds are returned to {card} within five days.",
    "{card} was declined by the bank again.",
    "Leave a message at {phone} after the beep.",
    "{phone} is the number of the night nurse.",
    "Forward the minutes to {email}, thanks.",
    "{email} has been removed from the list.",
    "Traffic to {ip} doubled overnight.",
)
# Written after a second measure and change, and measured once.
LAST = (
    "Nobody at the bakery could explain why {card} was on the bill.",
    "{card} expired in spring.",
    "The plumber gave us {phone} in case the pipe bursts.",
    "{phone} rings but nobody picks up.",
    "I forwarded the picture to {email} yesterday evening.",
    "{email} keeps sending us spam.",
    "Applications (PDF only) to {email} until the end of June.",
    "The nameserver moved from {ip} last night.",
)
PLAIN = (
    "The match ended 3-2 after extra time in front of 41250 people.",
    "Chapter 12 covers the years 1914-1918 and has 380 pages.",
    "Prices rose by 2.5 percent in 2019 and by 3.1 percent in 2020.",
    "Meet me at the station at noon, or at the cafe at the corner.",
    "Release 4.1.2 fixes 17 bugs and adds 3 features.",
    "The dot at the end of the line marks the place where they stopped.",
    "He phoned the office, left a card and walked home.",
    "Invoice 20481 of 12-05-2021 was paid in full.",
    "The library opens at 9.30 and closes at 18.00 on weekdays.",
    "In 1998 the town had 12500 inhabitants, 300 more than in 1990.",
)


def unseen_sentences(values, templates=UNSEEN, copies=10):
    """(text, [(start, end, kind)]): every template ``copies`` times, and the sentences without any entity."""
    out = []
    for _ in range(copies):
        for template in templates:
            kind = template[template.index("{") + 1 : template.index("}")]
            value, at = values.value(kind), template.index("{")
            out.append((template.replace("{" + kind + "}", value), [(at, at + len(value), kind)]))
    out += [(text, []) for text in PLAIN]
    random.Random(3).shuffle(out)
    return out
