"""Known addresses as (lat, lon, number, street, city, postcode)."""

#: All different.
DIFFERENT = [
    (47.909945, 7.213803, '15', 'Rue du Général de Gaulle', 'Guebwiller', '68500'),
    (47.936446, 7.234064, '15', 'Rue du Général de Gaulle', 'Orschwihr', '68500'),
    (50.467103, 2.041016, '67', 'Rue Principale', 'Sains-lès-Fressin', '62310'),
    (50.484447, 2.026269, '67', 'Rue Principale', 'Torcy', '62310'),
    (50.497481, 2.058977, '67', 'Rue Principale', 'Créquy', '62310'),
    (48.580068, -2.057383, '2E', 'Rue Jean Boyer', 'Pleurtuit', '35730'),
    (48.579941, -2.057431, '2D', 'Rue Jean Boyer', 'Pleurtuit', '35730'),
    (48.584172, -2.059568, '2D', "Rue de l'Aéroport", 'Pleurtuit', '35730'),
    (48.584326, -2.05963, '2E', "Rue de l'Aéroport", 'Pleurtuit', '35730'),
    (44.9120097, 4.9059023, '179', 'Boulevard du Maréchal Juin', None, None),
    (44.1068608, 3.0824739, '82', 'Avenue Jean Jaurès', None, '12100'),
    (43.3315513, 3.2474108, '1', 'Avenue de la Dévèze', 'Béziers', '34500'),
    (45.70697, 4.98698, '91', 'Route de Grenoble', None, None),
    (45.7807419, 4.827264, '71', 'Boulevard des Canuts', None, None),
    (45.910102, 6.1180954, '4 bis', 'Chemin des Alluèges', 'Annecy', '74000'),
    (49.8809429, 2.3303878, '190', 'Chaussée Jules Ferry', 'Amiens', '80000'),
    (47.9794297, -4.0899324, '27', 'Boulevard Flandres-Dunkerque', None, '29000'),
    (47.0084079, 3.1524708, '16', 'Boulevard Camille Dagonneau', 'Varennes-Vauzelles', '58640'),
    (46.3796434, 5.8393315, '16', 'Route de Lyon', 'Saint-Claude', '39200'),
    (45.4985844, 5.1374261, '51', 'Route Nationale', 'Saint-Jean-de-Bournay', '38440'),
    (43.2852037, 3.5137233, '8', 'Avenue des Sergents', None, '34300'),
    (48.9278044, 2.4738176, '60/68', 'Avenue Paul Vaillant-Couturier', None, '93150'),
    (45.9093367, 6.1178386, '18', 'Boulevard de la Rocade', 'Annecy', '74000'),
    (44.6524107, -1.1468754, '7', 'Boulevard Mestrezat', 'Arcachon', '33120'),
    (45.5739176, 4.8106452, '1515', 'Avenue Frédéric Mistral', None, '38670'),
    (47.5931448, 7.5556247, '122', 'Rue de Mulhouse', 'Saint-Louis', '68300'),
    (48.8549783, 2.2224884, '65', 'Quai Marcel Dassault', 'Saint-Cloud', '92210'),
    (44.1853181, 0.6635917, '1500', 'Avenue du Docteur Jean Noguès', 'Boé', '47550'),
    (48.9968223, 2.1889164, '177', 'Boulevard Victor Bordier', 'Montigny-lès-Cormeilles', '95370'),
    (45.6970078, 4.8248891, '126', "Boulevard de l'Europe", None, '69310'),
    (45.7057892, 4.8776592, '61', 'Avenue De La République', None, None),
    (49.0345691, 3.3918224, '26', "Avenue de l'Europe", 'Château-Thierry', '02400'),
    (43.3484537, 5.3770094, '60', 'Boulevard Roland Dorgelès', None, None),
    (44.0896945, 6.2370781, '8', 'Avenue du 8 Mai 1945', 'Digne-les-Bains', '04000'),
    (43.5334155, 6.9337917, '700', 'Avenue de Fréjus', None, '06210'),
    (48.9484072, 2.3427555, '53', 'Route de Saint-Leu', 'Épinay-sur-Seine', '93800'),
    (49.2480581, 2.4765268, '16', 'Route de Chantilly', 'Creil', '60100'),
    (49.2709818, -0.6942606, '16', 'Boulevard Sadi Carnot', None, '14400'),
    (50.6889062, 1.6188693, '43', 'Boulevard de la Liane', None, None),
    (43.655, 0.565, '203', 'Rue Victor Hugo', None, '32000'),
    (48.929039, 2.1887294, '84', 'Boulevard Henri Barbusse', None, None),
    (48.6772732, 2.1983691, '4', "Avenue de l'Océanie", 'Les Ulis', '91940'),
    (43.4431978, 5.2243108, '92', 'Aéroport de Marseille-Provence', 'Marignane', '13700'),
    (48.0753606, 6.8844619, '68', 'Boulevard Kelsch', 'Gérardmer', '88400'),
    (48.5281698, 2.0237213, '48', 'Rue Raymond Laubier', 'Dourdan', '91410'),
    (44.1461289, 4.6147401, '98', 'Route de Nîmes', None, '30200'),
    (48.6641609, 5.8883554, '678', 'Avenue Général Bigeard', None, None),
    (49.1382703, 0.1719857, '61', 'Boulevard Sainte-Anne', None, '14100'),
    (48.7816729, 2.0212207, '10', 'Route nationale 10', None, '78190'),
    (42.979619, 1.1445247, '5', 'Avenue de la Résistance', 'Saint-Girons', '09200'),
    (49.3974479, 3.3549302, '7', 'Rue du Stade', 'Crouy', '02880'),
    (48.4104597, -4.5154023, '225', "Boulevard de l'Europe", None, '29200'),
    (45.1953082, 5.7501193, '7', 'Avenue de Verdun', 'La Tronche', '38700'),
    (48.6906049, 2.4544168, '6', 'Route Forestière du Château', None, '91230'),
    (44.1160899, 3.07014, '150', 'Boulevard Georges Brassens', None, '12100'),
    (45.7717681, 4.9796964, '403', 'Avenue Jean Jaurès', None, None),
    (50.2905559, 3.1518418, '15 ter', 'Route Nationale', 'Bugnicourt', '59150'),
    (45.4240741, 4.4112816, '12', 'Boulevard Karl Marx', 'Saint-Étienne', '42000'),
    (48.1586567, 6.4521936, '30', 'Rue de Remiremont', None, '88000'),
    (48.7417444, 7.0781027, '8', 'Rue de Strasbourg', 'Sarrebourg', '57400'),
    (46.4830276, 3.9748969, '19', 'Avenue des Platanes', None, '71160'),
    (49.2246582, 2.9051749, '61', 'Rue Henri Laroche', 'Crépy-en-Valois', '60800'),
    (43.8433908, -0.7606191, '1850', 'Route de Lalande Champigny', 'Carcarès-Sainte-Croix', '40400'),
    (45.6828731, 4.9540834, '119', "Route d'Heyrieux", None, None),
    (48.7403042, 2.3149999, '134', 'Rue Pascal', 'Antony', '92160'),
    (45.9448213, 6.6301458, '934', 'Avenue de Genève', None, None),
    (49.189328, -0.348169, '75', 'Boulevard Georges Clemenceau', 'Caen', '14000'),
    (50.4810893, 2.9372452, '75', 'Rue Florent Evrard', 'Carvin', '62220'),
    (49.5076127, -1.4658201, '1', 'Boulevard Verdun', 'Valognes', '50700'),
    (48.8603361, 2.3473416, '8', 'Rue Sainte-Opportune', 'Paris', '75001'),
    (49.1149082, 2.2810976, '78', 'Rue Pierre Brossolette', 'Presles', '95590'),
    (45.7669987, 4.8299891, '1', "Rue d'Algérie", 'Lyon', '69001'),
    (45.7559244, 4.8339202, '10', 'Place Antonin Poncet', 'Lyon', '69002'),
    (43.5125, 5.471944, '50', 'Avenue Henri Malacrida', None, '13100'),
    (47.0732277, 2.394326, '26', "Boulevard de l'Industrie", None, None),
    (43.445, 3.798889, '60', "Avenue d'Ingril", 'Frontignan', '34110'),
    (43.2407744, 6.5734098, '370', 'Route du Bourrian', 'Gassin', '83580'),
    (43.7018892, 6.9952681, '965', 'Chemin des Vergers', 'Le-Bar-sur-Loup', '06620'),
    (45.9536858, -1.3792735, '850', 'Rue de Ponthezière', None, '17190'),
    (44.9858563, 6.1199582, '102', 'Route du Grand Pré', 'Les Deux Alpes', '38520'),
    (45.940833, 4.726389, '495', 'Avenue Jean Vacher', None, None),
    (43.0405623, 6.142783, '153', 'Route de la Madrague', 'Giens, Hyères', '83400'),
    (45.802222, 6.209722, '862', 'Route de la Ravoire', 'Doussard', '74210'),
    (47.588333, -3.015, '2', 'lieu dit Kernivilit', 'Saint-Philibert', '56470'),
    (48.8705516, 2.2287072, '3', 'Rue Ledru-Rollin', 'Suresnes', '92150'),
    (48.8719158, 2.2221748, '32', 'Avenue Franklin Roosevelt', 'Suresnes', '92150'),
    (48.7264167, 2.0491708, '2', 'route de Romainville', None, '78470'),
    (48.8883391, 2.3034488, '11', 'Rue Nicolas Chuquet', None, '75017'),
    (43.539959, 1.5106777, '105', 'Avenue la Méridienne', 'Labège', '31670'),
    (43.5408025, 1.5120412, '269', 'La Méridienne', 'Labège', '31670'),
    (43.6436341, 1.5220926, '13/14', 'Chemin du Logis Vieux', None, '31850'),
    (47.6586202, -2.7919534, '95', 'Avenue de la Marne', 'Vannes', '56000'),
    (45.8168426, 6.7249451, '22', 'Route du Plan du Moulin', 'Les Contamines-Montjoie', '74170'),
    (48.1238866, -1.6595946, '205', 'Rue de Fougères', 'Rennes', '35700'),
    (48.9832626, 8.2090531, '11d', 'Ludwigstraße', 'Berg (Pfalz)', '76768'),
    (48.9833324, 8.2046975, '1', 'Theresienstraße', 'Berg (Pfalz)', '76768'),
    (48.7658322, 2.162263, '50', 'Avenue Jean Jaurès', 'Jouy-en-Josas', '78350'),
    (48.981287, 8.1991047, '11', 'Lukasstraße', 'Berg (Pfalz)', '76768'),
    (48.9824053, 8.2048926, '9', 'Theresienstraße', 'Berg (Pfalz)', '76768'),
    (48.9829293, 8.2048303, '6', 'Theresienstraße', 'Berg (Pfalz)', '76768'),
    (42.6140878, 2.4223982, '20', 'Avenue du Docteur Arrous', 'Prades', '66500'),
    (42.6176076, 2.4241133, '4', 'Rue Victor Hugo', 'Prades', '66500'),
    (45.6863467, 6.3952524, '2', 'Route de la Biolle', 'Pallud', '73200'),
    (48.8245263, 2.364154, '41', 'Rue du Disque', None, None),
    (48.9355197, 2.2076713, '151', 'Avenue Gabriel Péri', 'Bezons', '95870'),
    (43.5828023, 3.8808803, '905', "Rue de l'Industrie", 'Montpellier', '34000'),
    (43.6093105, 3.8801472, '9', 'Passage Bruyas', None, '34000'),
    (48.1151239, -1.6576676, '5', 'Boulevard de Metz', 'Rennes', '35000'),
    (48.1205564, -1.6653987, '129', 'Rue de Fougères', 'Rennes', '35700'),
]

#: Ten addresses in several spellings.
SPELLINGS = [
    (48.85504, 2.22249, '65', 'Quai Marcel Dassault', 'Saint-Cloud', '92210'),
    (48.85497, 2.22255, '65', 'quai marcel dassault', 'saint cloud', '92210'),
    (48.85504, 2.22248, '65', 'quai marcel dassault', None, None),
    (44.18536, 0.66359, '1500', 'Avenue du Docteur Jean Noguès', 'Boé', '47550'),
    (44.18532, 0.66367, '1500', 'Avenue Dr. Jean Noguès', 'Boé', '47550'),
    (44.18535, 0.66366, '1500', 'av. du dr. jean noguès', None, None),
    (48.99685, 2.18891, '177', 'Boulevard Victor Bordier', 'Montigny-lès-Cormeilles', '95370'),
    (48.99682, 2.18897, '177', 'Bd. Victor Bordier', None, None),
    (48.99686, 2.18893, '177', 'boulevard victor bordier', None, None),
    (45.69705, 4.82488, '126', "Boulevard de l'Europe", None, '69310'),
    (45.69707, 4.82488, '126', 'Boulevard de l Europe', None, None),
    (45.697, 4.82497, '126', 'bvd de l europe', None, '69310'),
    (45.70583, 4.87766, '61', 'Avenue De La République', None, None),
    (45.70579, 4.87765, '61', 'av. république', None, None),
    (44.08969, 6.23707, '8', 'Avenue du 8 Mai 1945', 'Digne-les-Bains', '04000'),
    (44.08976, 6.23711, '8', 'Avenue du 8 Mai 1945', 'Digne-les-Bains', '04000'),
    (44.08978, 6.23712, '8', 'Avenue du 8 Mai 1945', 'Digne-les-Bains', '04000'),
    (48.94847, 2.34279, '53', 'Route de Saint-Leu', 'Épinay-sur-Seine', '93800'),
    (48.9484, 2.34275, '53', 'route de saint leu', 'Épinay-sur-Seine', '93800'),
    (48.9484, 2.34284, '53', 'rt. saint leu', 'Épinay-sur-Seine', '93800'),
    (49.03465, 3.39182, '26', "Avenue de l'Europe", 'Château-Thierry', '02400'),
    (49.0346, 3.3919, '26', "av. de l'europe", None, '02400'),
    (49.0346, 3.3925, '26', "Route de l'Europe", 'Château-Thierry', '02400'),
    (49.0346, 3.3937, '26', 'route de l europe', 'Château-Thierry', '02400'),
    (49.03463, 3.3935, '27', 'route de l europe', 'Château-Thierry', '02400'),
    (49.0346, 3.3935, '27', "route de l'europe", 'Château-Thierry', None),
]
