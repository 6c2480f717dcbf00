"""Deterministic support-ticket generator (template x slot draws).

Each input id becomes one ticket: category ``id % 10``, variant
``(id // 10) % 2``; the five slots are drawn from an md5 of
``seed|id|slot`` so any engine with md5 reproduces the same rows. Same
distribution and determinism as a seeded RNG, not the same bytes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_SEED

# Slot vocabularies.
PRODUCTS = (
    "wireless headphones", "mechanical keyboard", "standing desk",
    "office chair", "4K monitor", "USB-C hub", "laptop stand",
    "webcam", "desk lamp", "ergonomic mouse",
)
CITIES = ("Austin", "Denver", "Seattle", "Boston", "Chicago", "Miami")
NAMES = ("Alex", "Priya", "Jordan", "Sam", "Lena", "Marco", "Nina", "Tom")
ORDER_ID_RANGE = (10000, 99999)
DAYS_RANGE = (2, 7)

# Fixed values: (category, [(email template, reply template), ...]) in order.
# Slots: {oid} order id, {p} product, {city}, {name} agent name, {days}.
TEMPLATES = (
    ("Shipping", (
        ("My order {oid} for the {p} was supposed to arrive {days} days ago "
         "but the tracking hasn't updated. Where is it?",
         "Hi, thanks for reaching out. I'm sorry your {p} (order {oid}) is "
         "delayed. I've checked with the carrier — it's currently in transit "
         "and expected within {days} business days. Here is your live tracking "
         "link. I'll personally monitor it and update you if anything changes. "
         "— {name}"),
        ("I received the wrong item for order {oid}. I ordered a {p} but got "
         "something else entirely.",
         "Hi, I'm really sorry about the mix-up on order {oid}. I've created a "
         "prepaid return label for the incorrect item and shipped the correct "
         "{p} today at no cost to you. It should arrive in {days} business "
         "days. Apologies again for the inconvenience. — {name}"),
    )),
    ("Refund", (
        ("I returned my {p} two weeks ago (order {oid}) and still haven't seen "
         "a refund. Please help.",
         "Hi, thank you for your patience. I can confirm we received your "
         "returned {p} for order {oid}. I've just processed your full refund — "
         "it will appear on your original payment method within {days} business "
         "days. You'll get an email confirmation shortly. — {name}"),
        ("The {p} didn't meet my expectations. I'd like a refund for order "
         "{oid}.",
         "Hi, I'm sorry the {p} wasn't the right fit. You're well within our "
         "30-day window, so I've approved your refund for order {oid}. Once you "
         "drop off the item using the attached label, the refund of the full "
         "amount posts within {days} business days. — {name}"),
    )),
    ("Replacement", (
        ("My {p} from order {oid} arrived damaged — the screen is cracked.",
         "Hi, I'm so sorry your {p} arrived damaged. That's not the experience "
         "we want. I've shipped a replacement {p} today via express (order "
         "{oid}), arriving in {days} business days, and included a return label "
         "for the damaged unit. No further action needed on your end. — {name}"),
        ("The {p} I bought stopped working after a week. Can I get a "
         "replacement? Order {oid}.",
         "Hi, sorry to hear the {p} failed so quickly — it's covered under "
         "warranty. I've queued a replacement for order {oid} shipping today, "
         "ETA {days} business days. Please recycle the faulty unit; no need to "
         "return it. Let me know if the new one gives any trouble. — {name}"),
    )),
    ("Billing", (
        ("I was charged twice for order {oid}. Can you fix this?",
         "Hi, thanks for flagging this. You're right — I can see a duplicate "
         "charge on order {oid}. I've reversed the extra charge immediately; it "
         "will drop off your statement within {days} business days. Apologies "
         "for the worry. — {name}"),
        ("There's a charge on my card I don't recognise, possibly related to "
         "my {p} purchase.",
         "Hi, I understand how concerning an unexpected charge is. I looked "
         "into it: the charge corresponds to your {p} order plus applicable "
         "tax. I've emailed you the itemised receipt. If it still looks wrong, "
         "reply here and I'll escalate to our billing team. — {name}"),
    )),
    ("Subscription", (
        ("I want to upgrade my subscription plan but the page keeps erroring.",
         "Hi, sorry the upgrade page is misbehaving. I've applied the upgrade "
         "to your account manually — you now have the higher tier effective "
         "today, prorated for this cycle. You should see the new features "
         "within a few minutes. — {name}"),
        ("Why did my subscription price go up this month?",
         "Hi, great question. Your introductory promotional rate ended this "
         "cycle, so the plan returned to its standard price. I've applied a "
         "one-time loyalty credit to soften the change and emailed you the "
         "breakdown. Let me know if you'd like to review other plans. — {name}"),
    )),
    ("Technical Support", (
        ("The {p} won't connect to my laptop over Bluetooth no matter what I "
         "try.",
         "Hi, let's get your {p} connected. Please (1) forget the device in "
         "Bluetooth settings, (2) hold the pairing button for 5 seconds until "
         "the light blinks, then (3) re-pair. This resolves it in most cases. "
         "If it still fails, reply and I'll arrange a replacement. — {name}"),
        ("Your app keeps crashing on startup after the latest update.",
         "Hi, sorry about the crashes. Our team identified a bug in the latest "
         "build. Please update to version 4.2.1 (now live) or reinstall — that "
         "clears the corrupted cache causing it. I've credited your account for "
         "the disruption. — {name}"),
    )),
    ("Password Reset", (
        ("I can't log in and the password reset email never arrives.",
         "Hi, sorry for the login trouble. I've manually triggered a reset link "
         "to your registered email — please also check spam. It expires in 30 "
         "minutes. If it still doesn't arrive, confirm your account email and "
         "I'll verify it's correct on our side. — {name}"),
        ("I forgot my password and the reset link says it expired.",
         "Hi, no problem — reset links expire after 30 minutes for security. "
         "I've sent a fresh link that's valid now. Click it, choose a new "
         "password, and you'll be back in. Let me know if you hit any snag. "
         "— {name}"),
    )),
    ("Account Issues", (
        ("My account shows the wrong shipping address and I can't edit it.",
         "Hi, thanks for letting me know. I've unlocked and corrected the "
         "shipping address on your account — please double-check it now looks "
         "right. The edit restriction was caused by a pending order; it's "
         "cleared now. — {name}"),
        ("I think my account was accessed by someone else.",
         "Hi, I take this seriously. I've secured your account: forced a "
         "sign-out of all sessions and locked new logins pending a reset. "
         "Please use the reset link I just sent to set a new password. I've "
         "also enabled login alerts. — {name}"),
    )),
    ("Cancellation", (
        ("Please cancel my order {oid} for the {p}, I ordered by mistake.",
         "Hi, done — I've cancelled order {oid} for the {p} before it shipped, "
         "so you won't be charged. Any pending authorisation will drop off "
         "within {days} business days. Thanks for catching it early. — {name}"),
        ("I'd like to cancel my subscription effective immediately.",
         "Hi, I've cancelled your subscription effective today; you won't be "
         "billed again. You'll keep access until the end of the current paid "
         "period. We'd love feedback on why you're leaving if you have a "
         "moment. — {name}"),
    )),
    ("General Questions", (
        ("Do you ship internationally, and how long does it take to {city}?",
         "Hi, yes! We ship to most countries. To {city}, standard international "
         "delivery is typically {days} business days plus any customs "
         "clearance. You'll get full tracking at dispatch. Let me know if "
         "you'd like the express option. — {name}"),
        ("What's your warranty policy on the {p}?",
         "Hi, great question. The {p} comes with a 2-year limited warranty "
         "covering manufacturing defects. If anything fails in that window, we "
         "repair or replace it free. Keep your order confirmation as proof of "
         "purchase. — {name}"),
    )),
)

N_CATEGORIES = len(TEMPLATES)
N_VARIANTS = 2
SLOTS = ("oid", "p", "city", "name", "days")


def template_rows() -> list[tuple[int, str, int, str, str]]:
    """The template dimension as rows ``(category_no, category, variant,
    email_t, reply_t)``."""
    return [(c, name, v, e, r)
            for c, (name, variants) in enumerate(TEMPLATES)
            for v, (e, r) in enumerate(variants)]


def template_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        template_rows(),
        "category_no INT, category STRING, variant INT, email_t STRING, reply_t STRING")


def slot_draw(id_col: Column, slot: str, seed: int) -> Column:
    """Deterministic draw in [0, 2^32): first 8 hex digits of
    md5('seed|id|slot')."""
    key = F.concat_ws("|", F.lit(str(seed)), id_col.cast("string"), F.lit(slot))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def _pick(values: tuple[str, ...], draw: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (draw % len(values) + 1).cast("int"))


def generate_tickets(ids: DataFrame, id_col: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """D1 over any DataFrame of ids (``spark.range(n)`` gives the classic
    ``n``-row dataset). Output ``id, customer_email, support_reply, category``.

    The template dimension has 20 rows, so broadcasting it is always safe."""
    lo, hi = ORDER_ID_RANGE
    dlo, dhi = DAYS_RANGE
    i = F.col(id_col).cast("bigint")
    slots = ids.select(
        i.alias("id"),
        (i % N_CATEGORIES).cast("int").alias("category_no"),
        ((i / N_CATEGORIES).cast("bigint") % N_VARIANTS).cast("int").alias("variant"),
        F.concat(F.lit("#"), (slot_draw(i, "oid", seed) % (hi - lo + 1) + lo)
                 .cast("string")).alias("oid"),
        _pick(PRODUCTS, slot_draw(i, "p", seed)).alias("p"),
        _pick(CITIES, slot_draw(i, "city", seed)).alias("city"),
        _pick(NAMES, slot_draw(i, "name", seed)).alias("name"),
        (slot_draw(i, "days", seed) % (dhi - dlo + 1) + dlo).cast("string").alias("days"),
    )
    dim = F.broadcast(template_dim(ids.sparkSession))
    joined = slots.join(dim, ["category_no", "variant"], "inner")

    def fill(template: str) -> Column:
        out = F.col(template)
        for s in SLOTS:
            out = F.replace(out, F.lit("{" + s + "}"), F.col(s))
        return out

    return joined.select("id", fill("email_t").alias("customer_email"),
                         fill("reply_t").alias("support_reply"), "category")


def tickets_from_table(table: DataFrame, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """One ticket per row of an input table, keyed by that table's id."""
    return generate_tickets(table.select(F.col(id_col).alias("id")), "id", seed)
