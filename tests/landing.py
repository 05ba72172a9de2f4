"""Small synthetic events, landed as JSON pages."""

import json
import os

from rollcall.plans import camp_h, camp_l, camp_t, day_j


def write_json(path, document):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(document, f, ensure_ascii=False)


def land_pages(root, collection, pages):
    for n, results in enumerate(pages, 1):
        link = f"https://example.org/{collection}?page={n + 1}" if n < len(pages) else None
        write_json(f"{root}/{collection}/page-{n:06d}.json", {"next": link, "results": results})


def position(pid, first="F", last="L", item=1, answers=None, **more):
    return {
        "id": pid, "item": item, "price": "10.00",
        "attendee_name_parts": {"given_name": first, "family_name": last},
        "attendee_email": None, "street": "Weg 1", "zipcode": "70000", "city": "Stadt", "country": "DE",
        **({} if answers is None else {"answers": answers}), **more,
    }


def order(code, positions, status="p", when="2025-01-05T10:00:00+01:00", **more):
    return {
        "code": code, "status": status, "email": f"{code}@example.org", "total": "10.00",
        "datetime": when, "positions": positions,
        "invoice_address": {
            "name": "Name", "company": "", "street": "Gasse 2", "zipcode": "70001",
            "city": "Dorf", "country": "DE", "vat_id": "",
        },
        **more,
    }


class Event:
    """Catalogue by text, so that answers can be given by text too."""

    def __init__(self, texts, choices, place_question):
        self.ids = {text: i for i, text in enumerate(texts, 1)}
        self.choices, self.place_question = choices, place_question

    def answers(self, given):
        return [{"question": self.ids[t], "answer": a} for t, a in given.items()]

    def ticket(self, pid, first, last, answers=None, **more):
        return position(pid, first, last, answers=self.answers(answers or {}), **more)

    def land(self, root, orders, items=None, per_page=2):
        items = items or [{"id": 1, "name": {"de": "Ticket"}}]
        questions = [{"id": i, "question": {"de": t}} for t, i in self.ids.items()]
        land_pages(root, "orders", [orders[i:i + per_page] for i in range(0, len(orders), per_page)])
        land_pages(root, "questions", [questions[:3], questions[3:]])
        land_pages(root, "items", [items])
        for text, i in self.ids.items():
            options = [{"id": n, "answer": {"de": c}} for n, c in enumerate(self.choices)]
            write_json(
                f"{root}/question_details/{i}.json",
                {"id": i, "question": {"de": text},
                 "options": options if text == self.place_question else []},
            )
        return root


def event_of(module, choices, texts=None):
    return Event(texts or module.QUESTIONS, choices, module.FAMILY.place_question)


DEFAULT_CHOICES = {
    camp_h: ["Süd", "Nord", "Leer"],
    camp_l: ["Aalen", "Bonn", "Leer", camp_l.NO_PLACE],
    camp_t: ["Aalen", "Bonn", "Leer", camp_l.NO_PLACE],
    day_j: ["Aalen", "Bonn", "Leer"],
}
