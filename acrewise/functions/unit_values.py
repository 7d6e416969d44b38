"""Fixed values of the unit cleaner: sector spellings, amenity weights, age labels."""

# Fixed values: (old, new) sector spellings replaced before rare sectors are dropped, in order.
SECTOR_ALIASES = [
    ("dharam colony", "sector 12"),
    ("krishna colony", "sector 7"),
    ("suncity", "sector 54"),
    ("prem nagar", "sector 13"),
    ("mg road", "sector 28"),
    ("gandhi nagar", "sector 28"),
    ("laxmi garden", "sector 11"),
    ("shakti nagar", "sector 11"),
    ("baldev nagar", "sector 7"),
    ("shivpuri", "sector 7"),
    ("garhi harsaru", "sector 17"),
    ("imt manesar", "manesar"),
    ("adarsh nagar", "sector 12"),
    ("shivaji nagar", "sector 11"),
    ("bhim nagar", "sector 6"),
    ("madanpuri", "sector 7"),
    ("saraswati vihar", "sector 28"),
    ("arjun nagar", "sector 8"),
    ("ravi nagar", "sector 9"),
    ("vishnu garden", "sector 105"),
    ("bhondsi", "sector 11"),
    ("surya vihar", "sector 21"),
    ("devilal colony", "sector 9"),
    ("valley view estate", "gwal pahari"),
    ("mehrauli  road", "sector 14"),
    ("jyoti park", "sector 7"),
    ("ansal plaza", "sector 23"),
    ("dayanand colony", "sector 6"),
    ("sushant lok phase 2", "sector 55"),
    ("chakkarpur", "sector 28"),
    ("greenwood city", "sector 45"),
    ("subhash nagar", "sector 12"),
    ("sushant lok phase 3", "sector 57"),
    ("dlf phase 5", "sector 43"),
    ("rajendra park", "sector 105"),
    ("uppals southend", "sector 49"),
    ("sohna", "sohna road"),
    ("ashok vihar phase 3 extension", "sector 5"),
    ("south city 1", "sector 41"),
    ("ashok vihar phase 2", "sector 5"),
    ("dlf phase 1", "sector 26"),
    ("nirvana country", "sector 50"),
    ("palam vihar", "sector 2"),
    ("dlf phase 2", "sector 25"),
    ("sushant lok phase 1", "sector 43"),
    ("laxman vihar", "sector 4"),
    ("dlf phase 4", "sector 28"),
    ("dlf phase 3", "sector 24"),
    ("sohna road road", "sohna road"),
    ("malibu town", "sector 47"),
    ("surat nagar 1", "sector 104"),
    ("new colony", "sector 7"),
    ("mianwali colony", "sector 12"),
    ("jacobpura", "sector 12"),
    ("rajiv nagar", "sector 13"),
    ("ashok vihar", "sector 3"),
]

# Sector spellings replaced after rare sectors are dropped, in order.
SECTOR_ALIASES_AFTER = [
    ("sector 95a", "sector 95"),
    ("sector 23a", "sector 23"),
    ("sector 12a", "sector 12"),
    ("sector 3a", "sector 3"),
    ("sector 110 a", "sector 110"),
    ("patel nagar", "sector 15"),
    ("a block sector 43", "sector 43"),
    ("maruti kunj", "sector 12"),
    ("b block sector 43", "sector 43"),
    ("sector-33 sohna road", "sector 33"),
    ("sector 1 manesar", "manesar"),
    ("sector 4 phase 2", "sector 4"),
    ("sector 1a manesar", "manesar"),
    ("c block sector 43", "sector 43"),
    ("sector 89 a", "sector 89"),
    ("sector 2 extension", "sector 2"),
    ("sector 36 sohna road", "sector 36"),
]

# Weight of each amenity in the luxury score of a unit.
AMENITY_WEIGHTS = {
    "24/7 Power Backup": 8,
    "24/7 Water Supply": 4,
    "24x7 Security": 7,
    "ATM": 4,
    "Aerobics Centre": 6,
    "Airy Rooms": 8,
    "Amphitheatre": 7,
    "Badminton Court": 7,
    "Banquet Hall": 8,
    "Bar/Chill-Out Lounge": 9,
    "Barbecue": 7,
    "Basketball Court": 7,
    "Billiards": 7,
    "Bowling Alley": 8,
    "Business Lounge": 9,
    "CCTV Camera Security": 8,
    "Cafeteria": 6,
    "Car Parking": 6,
    "Card Room": 6,
    "Centrally Air Conditioned": 9,
    "Changing Area": 6,
    "Children's Play Area": 7,
    "Cigar Lounge": 9,
    "Clinic": 5,
    "Club House": 9,
    "Concierge Service": 9,
    "Conference room": 8,
    "Creche/Day care": 7,
    "Cricket Pitch": 7,
    "Doctor on Call": 6,
    "Earthquake Resistant": 5,
    "Entrance Lobby": 7,
    "False Ceiling Lighting": 6,
    "Feng Shui / Vaastu Compliant": 5,
    "Fire Fighting Systems": 8,
    "Fitness Centre / GYM": 8,
    "Flower Garden": 7,
    "Food Court": 6,
    "Foosball": 5,
    "Football": 7,
    "Fountain": 7,
    "Gated Community": 7,
    "Golf Course": 10,
    "Grocery Shop": 6,
    "Gymnasium": 8,
    "High Ceiling Height": 8,
    "High Speed Elevators": 8,
    "Infinity Pool": 9,
    "Intercom Facility": 7,
    "Internal Street Lights": 6,
    "Internet/wi-fi connectivity": 7,
    "Jacuzzi": 9,
    "Jogging Track": 7,
    "Landscape Garden": 8,
    "Laundry": 6,
    "Lawn Tennis Court": 8,
    "Library": 8,
    "Lounge": 8,
    "Low Density Society": 7,
    "Maintenance Staff": 6,
    "Manicured Garden": 7,
    "Medical Centre": 5,
    "Milk Booth": 4,
    "Mini Theatre": 9,
    "Multipurpose Court": 7,
    "Multipurpose Hall": 7,
    "Natural Light": 8,
    "Natural Pond": 7,
    "Park": 8,
    "Party Lawn": 8,
    "Piped Gas": 7,
    "Pool Table": 7,
    "Power Back up Lift": 8,
    "Private Garden / Terrace": 9,
    "Property Staff": 7,
    "RO System": 7,
    "Rain Water Harvesting": 7,
    "Reading Lounge": 8,
    "Restaurant": 8,
    "Salon": 8,
    "Sauna": 9,
    "Security / Fire Alarm": 9,
    "Security Personnel": 9,
    "Separate entry for servant room": 8,
    "Sewage Treatment Plant": 6,
    "Shopping Centre": 7,
    "Skating Rink": 7,
    "Solar Lighting": 6,
    "Solar Water Heating": 7,
    "Spa": 9,
    "Spacious Interiors": 9,
    "Squash Court": 8,
    "Steam Room": 9,
    "Sun Deck": 8,
    "Swimming Pool": 8,
    "Temple": 5,
    "Theatre": 9,
    "Toddler Pool": 7,
    "Valet Parking": 9,
    "Video Door Security": 9,
    "Visitor Parking": 7,
    "Water Softener Plant": 7,
    "Water Storage": 7,
    "Water purifier": 7,
    "Yoga/Meditation Area": 7,
}

# Possession text to age label; everything else is Undefined.
AGE_LABELS = {
    "10+ Year Old": "Old Property",
    "0 to 1 Year Old": "Moderately Old",
    "Under Construction": "Under Construction",
    "Within 6 months": "Undefined",
    "Jul 2024": "New Property",
    "Jun 2024": "New Property",
    "Aug 2025": "New Property",
    "Jan 2027": "New Property",
    "Apr 2024": "Relatively New",
    "Aug 2023": "Relatively New",
    "Dec 2023": "Relatively New",
    "Feb 2024": "Relatively New",
}

# Room kinds flagged from the additional-room text.
ROOM_KINDS = ["study room", "servant room", "store room", "pooja room", "others"]
