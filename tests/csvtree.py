"""A small raw-event tree written with plain file I/O (test input)."""

from pathlib import Path

U1 = "12345678-1234-5678-1234-567812345678"
U2 = "{87654321-4321-8765-4321-876543218765}"
U3 = "urn:uuid:11111111-2222-3333-4444-555555555555"


def write(base: Path, rel: str, text: str) -> None:
    p = base / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)


def build(base: Path) -> Path:
    d1 = "year=2025/month=06/day=01"
    d2 = "year=2025/month=06/day=02"
    write(base, f"{d1}/page_view.csv",
          "user_id,session_id,page_url,page_type,timestamp,time_on_page_seconds,referrer,device_type,country\n"
          f"{U1},s1,/,home,2025-06-01T10:00:00,30,google,mobile,Colombia\n"
          f"{U2},s2,/cart,cart,2025-06-01T10:01:00,12,direct,desktop,Peru\n"
          f"{U3},s2,/checkout,checkout,2025-06-01T10:02:00,NA,direct,desktop,Peru\n")
    write(base, f"{d1}/click.csv",
          "user_id,session_id,element_id,element_type,page_url,timestamp,x_position,y_position\n"
          f"{U1},s1,e1,button,/,2025-06-01T10:00:05,3.0,10\n"
          f"{U1},s1,e2,button,/,2025-06-01T10:00:06,4,1.5\n"
          f"bad-user,s1,e3,link,/,2025-06-01T10:00:07,-1,2\n"
          f"{U1},  ,e4,link,/,not-a-date,5,6\n"
          f"{U1},s1,e5,link,/,2025-06-01T10:00:09,x,6\n"
          f"{U1},s1,e6,link,/,2025-06-01T10:00:10,7,8\n")
    # reordered columns: must be read by name, not position
    write(base, f"{d1}/cart_event.csv",
          "action,timestamp,product_id,session_id,user_id\n"
          f"add,2025-06-01T10:03:00,P1,s2,{U2}\n"
          f"remove,2025-06-01T10:04:00,P1,s2,{U2}\n")
    # missing required column: price
    write(base, f"{d1}/product_view.csv",
          "user_id,session_id,product_id,category,timestamp,time_on_page_seconds\n"
          f"{U1},s1,P1,c1,2025-06-01T10:05:00,5\n"
          f"{U1},s1,P2,c1,2025-06-01T10:06:00,6\n")
    write(base, f"{d1}/search.csv", "user_id,session_id,query,results_count,timestamp\n")
    write(base, f"{d1}/notes.csv", "user_id,session_id,timestamp\n" f"{U1},s1,2025-06-01T10:00:00\n")
    write(base, f"{d2}/page_view.csv",
          "user_id,session_id,page_url,page_type,timestamp,time_on_page_seconds,referrer,device_type,country\n"
          f"{U1},s9,/,home,2025-06-02T09:00:00,40,google,tablet,Chile\n")
    return base
