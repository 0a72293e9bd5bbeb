"""Inline golden fixtures in the listing domain (the reference ships no sample data)."""

from __future__ import annotations


def card(house_id="101", title=" 南北,通透 两居 ", community="远洋山水", area="鲁谷",
         facts="2室1厅 | 89.5平米 | 南 北 | 精装 | 高楼层(共18层) | 板楼",
         total="560", unit="62570", tax="满五年", with_id=True, with_facts=True) -> str:
    hid = f' data-housecode="{house_id}"' if with_id else ""
    facts_html = f'<span class="houseIcon"></span>{facts}' if with_facts else f"<span>{facts}</span>"
    tax_html = f'<span class="taxfree">{tax}</span>' if tax else ""
    return (
        f'<li class="clear"><a class="img" href="#" target="_blank"><img src="t.jpg"></a>'
        f'<div class="info clear"><div class="title"><a class="" href="https://x/{house_id}.html"{hid}'
        f' target="_blank">{title}</a><!-- tag --></div>'
        f'<div class="flood"><div class="positionInfo"><span class="positionIcon"></span>'
        f'<a href="https://x/xiaoqu/1/" target="_blank">{community}</a>   -  '
        f'<a href="https://x/ershoufang/a/" target="_blank">{area}</a> </div></div>'
        f'<div class="address"><div class="houseInfo">{facts_html}</div></div>'
        f'<div class="tag">{tax_html}</div>'
        f'<div class="priceInfo"><div class="totalPrice totalPrice2"><i> </i><span class="">{total}'
        f'</span><i>万</i></div><div class="unitPrice" data-price="{unit}"><span>{unit}元/平</span>'
        f"</div></div></div></li>")


def page(*cards: str) -> str:
    return '<html><body><ul class="sellListContent">' + "".join(cards) + "</ul></body></html>"


def detail_page(items: list[tuple[str | None, str | None]], with_gallery=True) -> str:
    """items: (data-desc or None, img src or None)."""
    lis = []
    for desc, src in items:
        d = f' data-desc="{desc}"' if desc is not None else ""
        img = f'<img src="{src}" alt="">' if src is not None else "<span>x</span>"
        lis.append(f"<li{d}>{img}</li>")
    block = '<ul class="smallpic">' + "".join(lis) + "</ul>" if with_gallery else ""
    return f'<html><body><div class="thumbnail">{block}</div></body></html>'


def count_page(n) -> str:
    return f'<div class="resultDes">共找到<span> {n} </span>套丛台区二手房</div>'
