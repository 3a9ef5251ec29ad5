"""A made-up site for the pages' source; it notes what is asked for in the file named by the environment."""

import os

ASKED = os.environ.get("FOLIOFORGE_ASKED", "")


def site():
    def fetch(url):
        where, _, _ = url.partition("#")
        note = url.split("note=")[1]
        with open(note, "a") as out:
            out.write(where + "\n")
        if "down" in url:
            return 403, "no"
        return 200, f"<h1>{where}</h1>"

    return fetch
