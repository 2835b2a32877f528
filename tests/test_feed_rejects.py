"""Items and rejects of a damaged feed folder account for every record and file."""

import uuid

from loomwire.session import shared_folder
from loomwire.sources.feeds import feed_rejects, read_items

GOOD = """<?xml version="1.0"?><rss><channel>
<item><title>One</title><link>https://a.example/1</link><description>first</description></item>
<item><title>Two</title><link>https://a.example/2</link><description>second</description></item>
</channel></rss>"""
BROKEN = """<?xml version="1.0"?><rss><channel>
<item><title>Three</title><link>https://a.example/3</link><description>third</description></item>
<item><title>Four<link>https://a.example/4</link><description>unclosed</item>
</channel></rss>"""
ATOM = """<?xml version="1.0"?><feed><entry><title>Five</title><link href="https://b.example/5"/>
<summary>fifth</summary></entry></feed>"""


def test_items_and_rejects(spark, tmp_path):
    folder = f"{shared_folder(spark)}/feeds-{uuid.uuid4().hex}"
    import os

    local = folder.removeprefix("file:")
    os.makedirs(local)
    for name, text in (("good.xml", GOOD), ("broken.xml", BROKEN), ("atom.xml", ATOM), ("junk.xml", "not xml {")):
        with open(f"{local}/{name}", "w") as f:
            f.write(text)
    items = read_items(spark, folder).collect()
    rejects = {(r["feed"], r["reason"]): r["records"] for r in feed_rejects(spark, folder).collect()}
    by_file = {}
    for r in items:
        by_file[r["feed"]] = by_file.get(r["feed"], 0) + 1
    # every file is accounted for: items where they could be read, corrupt records (of the item and the entry pass)
    # where not, and files without any item or entry
    assert by_file == {"good.xml": 2, "broken.xml": 1, "atom.xml": 1}
    assert read_items(spark, folder).count() == 4  # a count alone reads a parsed column as well
    assert rejects == {("broken.xml", "corrupt record"): 2, ("junk.xml", "corrupt record"): 2,
                       ("junk.xml", "no items"): 0}
