"""Small delimited tables that several tests read."""

# Header names that the default catalogue knows, in an order of their own, over invented rows.
SAMPLE = """NAME,STALP,CITY,CERT,X,ZIP,Y,ADDRESS
Heron Savings,OR,Brackwater,301,-121.5,97001,44.25,8 Reed Walk
Tern & Daughters,ME,Low Harbour,4472,-68.125,04009,45.5,Pier 2
Plover Mutual,WA,Saltmarsh,96,-122.75,98003,47.0,61 Dune Road
Curlew Trust,VT,Upper Fen,15000,-72.5,05011,44.75,1 Mill Row
"""
FULL = """NAME,OPENED,CERT,CITY,X,Y,ZIP,STAFF,ADDRESS,STNAME,STALP,LONGITUDE,LATITUDE,SERVTYPE_DESC,NOTE
Heron Savings,1931,301,Brackwater,-121.5,44.25,97001,14,8 Reed Walk,Oregon,OR,-121.5,44.25,Counter,north
Tern & Daughters,1904,4472,Low Harbour,-68.125,45.5,04009,6,Pier 2,Maine,ME,-68.125,45.5,Counter,by boat
Plover Mutual,1977,96,Saltmarsh,-122.75,47.0,98003,40,61 Dune Road,Washington,WA,-122.75,47.0,Drive in,new
Curlew Trust,1862,15000,Upper Fen,-72.5,44.75,05011,3,1 Mill Row,Vermont,VT,-72.5,44.75,Counter,old
Avocet Union,1999,7,Mudford,-75.25,38.5,21012,22,9 Weir Lane,Maryland,MD,-75.25,38.5,By post,closed
"""
BLANKS = "ADDRESS,CERT,NAME\nQuay 4,,\n,12, \nHill 9,13,Tern\n"
SMALL = "CITY,ZIP,CERT,STALP,NAME,ADDRESS\nEelham,31005,640,GA,Stilt Bank,3 Sluice Gate\n"
