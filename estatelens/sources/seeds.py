"""Seed tables of the listing source: scrape-target cities and their resolved location ids.

Fixed values: these rows must equal the source's seeds (display names, voivodeships, MVP flags,
bounding boxes, location ids). They are kept verbatim, in their original order, as CSV text.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LOCATION_IDS_SCHEMA, LOOKUP_SCHEMA

# City lookup seed (source_city, city_name, voivodeship, is_mvp, bbox).
CITY_LOOKUP_CSV = """\
source_city,city_name,voivodeship,is_mvp,bbox_lat_min,bbox_lat_max,bbox_lon_min,bbox_lon_max
warszawa,Warszawa,mazowieckie,false,51.9774,52.482,20.6004,21.424
krakow,Kraków,małopolskie,false,49.8124,50.317,19.552,20.338
lodz,Łódź,łódzkie,false,51.5069,52.0115,19.0485,19.8635
wroclaw,Wrocław,dolnośląskie,false,50.8556,51.3602,16.6367,17.4403
poznan,Poznań,wielkopolskie,false,52.1541,52.6587,16.5117,17.3387
gdansk,Gdańsk,pomorskie,false,54.0997,54.6043,18.2138,19.0794
szczecin,Szczecin,zachodniopomorskie,false,53.1762,53.6808,14.1294,14.9762
bydgoszcz,Bydgoszcz,kujawsko-pomorskie,false,52.9433,53.3037,17.7081,18.3087
lublin,Lublin,lubelskie,false,51.0663,51.4267,22.2806,22.8562
bialystok,Białystok,podlaskie,false,52.9523,53.3127,22.8685,23.4691
katowice,Katowice,śląskie,true,50.0847,50.4451,18.7419,19.3057
gdynia,Gdynia,pomorskie,false,54.3387,54.6991,18.2201,18.8409
czestochowa,Częstochowa,śląskie,false,50.6316,50.992,18.8351,19.4055
radom,Radom,mazowieckie,false,51.2225,51.5829,20.8583,21.4359
rzeszow,Rzeszów,podkarpackie,false,49.8611,50.2215,21.7184,22.2796
sosnowiec,Sosnowiec,śląskie,true,50.1601,50.4123,18.9067,19.3015
torun,Toruń,kujawsko-pomorskie,false,52.8336,53.194,18.2986,18.8976
kielce,Kielce,świętokrzyskie,false,50.6859,51.0463,20.3431,20.9141
gliwice,Gliwice,śląskie,true,50.1684,50.4206,18.474,18.8688
zabrze,Zabrze,śląskie,true,50.1988,50.451,18.5881,18.9833
olsztyn,Olsztyn,warmińsko-mazurskie,false,53.5982,53.9586,20.1752,20.785
bielsko-biala,Bielsko-Biała,śląskie,true,49.6422,50.0026,18.7651,19.3237
bytom,Bytom,śląskie,true,50.2223,50.4745,18.7162,19.1116
zielona-gora,Zielona Góra,lubuskie,false,51.7554,52.1158,15.214,15.7984
rybnik,Rybnik,śląskie,false,49.9711,50.2233,18.3446,18.7378
ruda-slaska,Ruda Śląska,śląskie,false,50.1293,50.3815,18.659,19.0536
opole,Opole,opolskie,false,50.4919,50.8523,17.641,18.2096
tychy,Tychy,śląskie,true,50.0096,50.2618,18.7695,19.1631
gorzow-wielkopolski,Gorzów Wielkopolski,lubuskie,false,52.5566,52.917,14.9312,15.5264
dabrowa-gornicza,Dąbrowa Górnicza,śląskie,false,50.1959,50.4481,18.9988,19.3938
plock,Płock,mazowieckie,false,52.3666,52.727,19.4101,20.0027
elblag,Elbląg,warmińsko-mazurskie,false,53.972,54.3324,19.1011,19.7165
walbrzych,Wałbrzych,dolnośląskie,false,50.5915,50.9519,15.9994,16.5692
chorzow,Chorzów,śląskie,true,50.1716,50.4238,18.7774,19.1722
"""

# Resolved location ids per scrape target.
LOCATION_IDS_CSV = """\
source_city,city_id,region_id,matched_label
warszawa,17871,2,"Warszawa, Mazowieckie"
krakow,8959,4,"Kraków, Małopolskie"
lodz,10609,7,"Łódź, Łódzkie"
wroclaw,19701,3,"Wrocław, Dolnośląskie"
poznan,13983,1,"Poznań, Wielkopolskie"
gdansk,5659,5,"Gdańsk, Pomorskie"
szczecin,16705,11,"Szczecin, Zachodniopomorskie"
bydgoszcz,4019,15,"Bydgoszcz, Kujawsko-pomorskie"
lublin,10119,8,"Lublin, Lubelskie"
bialystok,1079,18,"Białystok, Podlaskie"
katowice,7691,6,"Katowice, Śląskie"
gdynia,5849,5,"Gdynia, Pomorskie"
czestochowa,4765,6,"Częstochowa, Śląskie"
radom,14673,2,"Radom, Mazowieckie"
rzeszow,15241,17,"Rzeszów, Podkarpackie"
sosnowiec,16027,6,"Sosnowiec, Śląskie"
torun,38395,15,"Toruń, Kujawsko-pomorskie"
kielce,7971,13,"Kielce, Świętokrzyskie"
gliwice,6091,6,"Gliwice, Śląskie"
zabrze,20327,6,"Zabrze, Śląskie"
olsztyn,12673,14,"Olsztyn, Warmińsko-mazurskie"
bielsko-biala,3231,6,"Bielsko-Biała, Śląskie"
bytom,4197,6,"Bytom, Śląskie"
zielona-gora,20787,9,"Zielona Góra, Lubuskie"
rybnik,15167,6,"Rybnik, Śląskie"
ruda-slaska,15041,6,"Ruda Śląska, Śląskie"
opole,12885,12,"Opole, Opolskie"
tychy,17705,6,"Tychy, Śląskie"
gorzow-wielkopolski,6331,9,"Gorzów Wielkopolski, Lubuskie"
dabrowa-gornicza,4905,6,"Dąbrowa Górnicza, Śląskie"
plock,13663,2,"Płock, Mazowieckie"
elblag,5453,14,"Elbląg, Warmińsko-mazurskie"
walbrzych,17829,3,"Wałbrzych, Dolnośląskie"
chorzow,22611,6,"Chorzów, Śląskie"
"""


def _rows(text: str, schema) -> list[tuple]:
    out = []
    reader = csv.DictReader(io.StringIO(text))
    for r in reader:
        vals = []
        for f in schema.fields:
            v = r[f.name]
            t = f.dataType.typeName()
            vals.append(v == "true" if t == "boolean" else float(v) if t == "double" else int(v) if t == "long" else v)
        out.append(tuple(vals))
    return out


def city_lookup(spark: SparkSession) -> DataFrame:
    """The 34-row city seed (a bounded dimension: broadcast wherever it is joined)."""
    return spark.createDataFrame(_rows(CITY_LOOKUP_CSV, LOOKUP_SCHEMA), LOOKUP_SCHEMA)


def location_ids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_rows(LOCATION_IDS_CSV, LOCATION_IDS_SCHEMA), LOCATION_IDS_SCHEMA)
